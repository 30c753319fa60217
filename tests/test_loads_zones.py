"""Rejecting loads, timestamp forms, session zones, whole sums, patches, scored files, folds without label."""

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from kestrel.functions.numeric import exact_difference, exact_sum
from kestrel.functions.temporal import auto_timestamp, local_date, offset_instant
from kestrel.operators import features, shape, star
from kestrel.operators.layout import month_of
from kestrel.session import ensure_checkpoint_dir
from kestrel.sources.tables import bulk_load_delimited, bulk_load_with_rejects, read_header_names, read_headered_csv

SCHEMA = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("price", T.DecimalType(8, 2)), T.StructField("name", T.StringType())])


def test_loads_fail_or_report(spark, tmp_path):
    p = tmp_path / "rows.txt"
    p.write_text("1|2.50|a\n2|12x|b\n3|123456789.00|c\nx|1.00|d\n5|1.00\n\\N|1.00|f\n7|\\N|\n8|0.125|h\n", encoding="utf-8")
    good, rejects = bulk_load_with_rejects(spark, str(p), SCHEMA)
    assert sorted((r["id"], str(r["price"]), r["name"]) for r in good.collect()) == [(1, "2.50", "a"), (7, "None", "")]
    assert {r["line"]: r["reason"] for r in rejects.collect()} == {
        "2|12x|b": "price: not decimal(8,2)", "3|123456789.00|c": "price: not decimal(8,2)", "x|1.00|d": "id: not bigint",
        "5|1.00": "2 fields", "\\N|1.00|f": "id: null", "8|0.125|h": "price: not decimal(8,2)"}
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        bulk_load_delimited(spark, str(p), SCHEMA).collect()


def test_headers_are_parsed_like_the_rows(spark, tmp_path):
    p = tmp_path / "clash.csv"
    p.write_text('id,"Monto, total",Dist,DIST\n1,2.5,3,4\n', encoding="utf-8")
    assert read_header_names(spark, str(p)) == ["id", "Monto, total", "Dist", "DIST"]
    got = read_headered_csv(spark, str(p))
    assert got.columns == ["ID", "MONTO, TOTAL", "DIST"] and tuple(got.first()) == (1, 2.5, 3)


def test_timestamp_forms(spark):
    forms = {"2024-03-05 06:07:08.25": dt.datetime(2024, 3, 5, 6, 7, 8, 250000), "2024-03-05T06:07": dt.datetime(2024, 3, 5, 6, 7),
             "3/5/2024 6:07 pm": dt.datetime(2024, 3, 5, 18, 7), "03/05/2024 12:00:01 AM": dt.datetime(2024, 3, 5, 0, 0, 1),
             "Mar 5, 2024": dt.datetime(2024, 3, 5), "5 MARCH 2024 10:11:12": dt.datetime(2024, 3, 5, 10, 11, 12),
             "20240305": dt.datetime(2024, 3, 5), "2024-03-05": dt.datetime(2024, 3, 5), "soon": None, "": None}
    got = spark.createDataFrame([(k,) for k in forms], "s string").select("s", auto_timestamp("s").alias("t")).collect()
    assert {r["s"]: r["t"] for r in got} == forms


def test_dates_do_not_depend_on_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 02:30:00' AS n, TIMESTAMP'2024-01-01 02:30:00+00:00' AS t, "
                       "TIMESTAMP_NTZ'2024-02-01 00:30:00' AS m, '2024-01-01 02:30:00-05:00' AS s")
        r = df.select(local_date("n").alias("n"), local_date("t").alias("t"), month_of("m").alias("m"), offset_instant("s").alias("s")).first()
        assert r["n"] == r["t"] == dt.date(2023, 12, 31) and r["m"] == "2024-02" and r["s"] == dt.datetime(2024, 1, 1, 7, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_sums_and_differences_keep_their_decimals(spark):
    df = spark.createDataFrame([("a", 0.004), ("a", 0.004), ("a", 0.004), ("b", 0.1), ("b", 0.2), ("c", None)], "k string, x double")
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(exact_sum("x").alias("s")).collect()}
    assert abs(got["a"] - 0.012) < 1e-12 and got["b"] == 0.3 and got["c"] is None
    d = spark.createDataFrame([(0.3, 0.1), (0.005, 0.001)], "a double, b double").select(exact_difference("a", "b").alias("d")).collect()
    assert d[0]["d"] == 0.2 and abs(d[1]["d"] - 0.004) < 1e-12


def test_a_repeated_patch_key_keeps_the_base_rows(spark):
    base = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "k int, v int")
    patch = spark.createDataFrame([(1, 5), (1, 4)], "k int, v int")
    assert sorted(map(tuple, star.update_from(base, patch, "k", ["v"]).collect())) == [(1, 4), (1, 4), (2, 20)]


def test_scored_rows_stay_as_read(spark):
    rows = [(1, None, 5), (1, None, 5), (None, None, 7), (2, None, None)]
    df = spark.createDataFrame(rows, "id int, toxic double, n int")
    out = shape.replace_from_clean(df, ["id", "Toxic", "N"], "toxic", lambda x: x.withColumn("p", F.col("N") * 2.0), "p")
    assert out.columns == ["id", "toxic", "n"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, 10.0, 5), (1, 10.0, 5), (None, 14.0, 7), (2, None, None)], key=repr)


def test_rows_without_label_are_in_no_fold(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 2) for i in range(40)], "i int, y int")
    got = features.stratified_folds(df, "y", "i", 4).collect()
    assert len(got) == 40 and all((r["fold"] is None) == (r["y"] is None) for r in got)
    assert {r["fold"] for r in got} == {None, 0, 1, 2, 3}


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
