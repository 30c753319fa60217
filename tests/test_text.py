"""Text expressions agree with the line parser semantics they rebuild (Python str/float rules)."""

import math

from pyspark.sql import functions as F

from kestrel.functions.text import after_first_colon, safe_double, split_fields, strip_quotes, ustrip


def py_float(tok: str, default=0.0):
    try:
        return float(tok)
    except ValueError:
        return default


TOKENS = ["12", "-3.5", "+.5", "1_000", "1__0", "_1", "1e3", "1E-2", "1.", ".5e1", "12d", "12f", "0x1p3",
          "inf", "-Infinity", "NaN", "+nan", "", "abc", "1.2.3", "1e", "--1", "7_5.2_5"]


def test_safe_double_matches_python(spark):
    df = spark.createDataFrame([(t,) for t in TOKENS], "t string")
    got = {r["t"]: r["x"] for r in df.select("t", safe_double("t").alias("x")).collect()}
    for t in TOKENS:
        want = py_float(t)
        if isinstance(want, float) and math.isnan(want):
            assert math.isnan(got[t]), t
        else:
            assert got[t] == want, (t, got[t], want)


def test_ustrip_matches_str_strip(spark):
    samples = ["  a b  ", "\tx\n", " y　", " z ", "", "   "]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(ustrip("s")).collect()]
    assert got == [s.strip() for s in samples]


def test_strip_quotes_and_colon(spark):
    rows = [('  "ABC" ',), ('""x""',), ('" A "',), ("AGENTE: Foo: bar ",), ("no colon",)]
    df = spark.createDataFrame(rows, "s string")
    got = df.select(strip_quotes("s").alias("q"), after_first_colon("s").alias("c")).collect()
    assert [r["q"] for r in got] == [s.strip().strip('"') for (s,) in rows]
    assert got[3]["c"] == "Foo: bar"  # text after the first colon only
    assert got[4]["c"] is None


def test_split_keeps_trailing_empties(spark):
    df = spark.createDataFrame([("a,,b,,",), ("x|y",)], "s string")
    r = df.select(split_fields("s", ",").alias("p"), split_fields("s", "|").alias("q")).collect()
    assert r[0]["p"] == "a,,b,,".split(",")
    assert r[1]["q"] == ["x", "y"]
