"""Column tools, keep-first, row totals, exact percentiles, mode, quality rules."""

import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from kestrel.operators import quality, shape, stats
from kestrel.sources.lines import hour_columns

HOURS = hour_columns()

# Four plants of the hourly declaration job and their daily totals.
GOLDEN_PLANTS = [("BETANIA", [364.0] * 24, 8736.0), ("ELQUIMBO", [85.0] * 24, 2040.0),
                 ("GUAVIO", [0.0] * 9 + [146.0, 120.0] + [180.0] * 5 + [120.0, 120.0, 997.0, 1002.0, 780.0, 140.0,
                                                                       0.0, 0.0], 4325.0),
                 ("PAGUA", [600.0] * 24, 14400.0)]


def test_golden_row_totals_and_positive_filter(spark):
    rows = [(name, *hours) for name, hours, _ in GOLDEN_PLANTS] + [("ZERO", *([0.0] * 24)),
                                                                   ("NANS", *([float("nan")] * 24))]
    df = spark.createDataFrame(rows, ["Central"] + HOURS)
    out = shape.keep_positive(shape.with_row_total(df, HOURS + ["Hora_99"], "Suma_Horas"), "Suma_Horas")
    got = {r["Central"]: r["Suma_Horas"] for r in out.collect()}
    assert got == {name: total for name, _, total in GOLDEN_PLANTS}


def test_keep_first_matches_pandas(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice(["a", "b", None, "c"]), rnd.randint(0, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "pos long, key string, v long")
    got = sorted((r["pos"], r["key"], r["v"]) for r in shape.keep_first(df, ["key"], ["pos"]).collect())
    pdf = pd.DataFrame(rows, columns=["pos", "key", "v"]).drop_duplicates(subset=["key"])
    want = sorted((int(a), None if b is None else b, int(c)) for a, b, c in pdf.itertuples(index=False))
    assert got == want
    assert shape.keep_first(df, ["key"], ["pos"]).columns == ["pos", "key", "v"]


def test_filter_by_sets_null_and_normalisation(spark):
    df = spark.createDataFrame([(" emgesa ", None, "h"), (None, "EMGESA S.A.", " T "), ("OTHER", "x", "H"),
                                ("EMGESA", "x", None)], "a string, b string, t string")
    out = shape.filter_by_sets(df, any_of=[("a", {"EMGESA", "EMGESA S.A."}), ("b", {"EMGESA", "EMGESA S.A."})],
                               all_of=[("t", {"H", "T"})])
    assert out.count() == 2


def test_dedup_columns_case_insensitive(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int").toDF("Dist_Max", "x", "DIST_MAX", "X")
    out = shape.dedup_columns_ci(df)
    assert out.columns == ["DIST_MAX", "X"]
    assert tuple(out.first()) == (1, 2)
    assert shape.common_columns(out, spark.createDataFrame([(1,)], "X int")) == ["X"]
    assert shape.split_by_type(spark.createDataFrame([(1, "s", 2.0)], "a int, b string, c double")) == (["a", "c"], ["b"])


def test_exact_percentiles_match_numpy(spark):
    rnd = random.Random(2)
    vals = [round(rnd.choice([rnd.uniform(0, 100), 5.0, 7.25]), 2) for _ in range(1001)] + [None] * 5
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    clean = np.array([v for v in vals if v is not None])
    for q in (0.5, 0.25, 0.9):
        got = stats.exact_percentile(df, "x", q, "p").first()["p"]
        assert math.isclose(got, float(np.percentile(clean, q * 100)), rel_tol=0, abs_tol=1e-9)
    even = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (3.0,)], "x double")
    assert stats.exact_median(even, "x", "m").first()["m"] == 2.5


def test_mode_ties_go_to_smallest(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (1,), (2,)], "x int")
    r = stats.mode_with_frequency(df, "x", "m", "f").first()
    assert (r["m"], r["f"]) == (1, 2)


def test_one_row_without_cross_join(spark):
    a = spark.createDataFrame([(1.5,)], "a double")
    b = spark.createDataFrame([(2, 3)], "b int, c int")
    r = stats.one_row([a, b])
    assert r.columns == ["a", "b", "c"] and tuple(r.first()) == (1.5, 2, 3)
    assert "CartesianProduct" not in r._jdf.queryExecution().executedPlan().toString()


def test_quality_rules(spark):
    df = spark.createDataFrame([(1, "A", -1.0, "Mínima"), (1, None, 2.0, "Otra"), (2, "ABCDEFGHIJK", 1e7, None)],
                               "id int, name string, price double, cloud string")
    rules = [quality.not_null("name"), quality.non_negative("price"), quality.max_length("name", 10),
             quality.decimal_fit("price", 8, 2), quality.domain("cloud", ["Mínima", "Parcial", "Total"]),
             quality.domain("cloud", ["Mínima", "Parcial", "Total"], allow_null=True), quality.unique("id")]
    rep = [tuple(r) for r in quality.quality_report(df, "t", rules).collect()]
    assert [v for *_, v in rep] == [1, 1, 1, 1, 2, 1, 1]
    bad = quality.violating_rows(df, rules)
    assert bad.count() == 3
    counts = quality.row_counts({"b": df, "a": df.limit(1)}).collect()
    assert [(r["tabla"], r["filas"]) for r in counts] == [("a", 1), ("b", 3)]


def test_wide_long_roundtrip(spark):
    df = spark.createDataFrame([(1, 1.5, 2.0), (2, 0.0, -1.0)], "k int, Hora_1 double, Hora_2 double")
    long = shape.wide_to_long(df, ["k"], ["Hora_1", "Hora_2"], "hora", "valor")
    back = shape.long_to_wide(long, ["k"], "hora", ["Hora_1", "Hora_2"], F.col("valor"), ["Hora_1", "Hora_2"])
    assert sorted(tuple(r) for r in back.collect()) == [(1, 1.5, 2.0), (2, 0.0, -1.0)]


def test_approx_opt_ins(spark):
    df = spark.range(0, 10001).select((F.col("id") % 1000).cast("double").alias("x"))
    assert stats.distinct_count(df, "x").first()[0] == 1000
    est = stats.distinct_count(df, "x", approx=True, rsd=0.05).first()[0]
    assert abs(est - 1000) <= 3 * 0.05 * 1000  # within three relative standard deviations
    p = stats.approx_percentile(df, "x", 0.5).first()[0]
    assert abs(p - float(np.percentile(np.arange(10001) % 1000, 50))) <= 1.0
