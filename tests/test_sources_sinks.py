"""Delimited bulk loads, headered CSV with case-clashing names, sinks, layouts, streaming refresh."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F, types as T

from kestrel.operators import layout
from kestrel.sources.sinks import export_single_csv, insert_select, save_table, write_csv
from kestrel.sources.tables import bulk_load_delimited, project_master, read_headered_csv, with_auto_timestamps
from kestrel.streaming import read_summary, start_summary_refresh

VENUE = T.StructType([T.StructField("venueid", T.ShortType()), T.StructField("venuename", T.StringType()),
                      T.StructField("venuecity", T.StringType()), T.StructField("venuestate", T.StringType()),
                      T.StructField("venueseats", T.IntegerType())])


def test_pipe_load_null_marker_and_quotes(spark, tmp_path):
    p = tmp_path / "venue.txt"
    p.write_text('1|Hall A|Town|ST|0\n2|"Quoted Arena|City|XX|\\N\n3|Same|City|XX|500\n', encoding="utf-8")
    df = bulk_load_delimited(spark, str(p), VENUE)
    rows = [tuple(r) for r in df.orderBy("venueid").collect()]
    assert rows == [(1, "Hall A", "Town", "ST", 0), (2, '"Quoted Arena', "City", "XX", None),
                    (3, "Same", "City", "XX", 500)]


def test_tab_load_unpadded_timestamps(spark, tmp_path):
    p = tmp_path / "sales.txt"
    p.write_text("1\t2/18/2008 2:36:48\n2\t12/14/2008 12:05:00\n", encoding="utf-8")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("ts", T.TimestampNTZType())])
    got = [r["ts"] for r in bulk_load_delimited(spark, str(p), schema, sep="\t",
                                                timestamp_format="M/d/yyyy H:mm:ss").orderBy("id").collect()]
    assert got == [dt.datetime(2008, 2, 18, 2, 36, 48), dt.datetime(2008, 12, 14, 12, 5, 0)]


def test_auto_timestamps(spark):
    df = spark.createDataFrame([("2008-01-05 10:00:00",), ("3/7/2008 1:02:03",), ("20080105",), ("nope",)], "t string")
    got = [r["t"] for r in with_auto_timestamps(df, ["t"]).collect()]
    assert got == [dt.datetime(2008, 1, 5, 10), dt.datetime(2008, 3, 7, 1, 2, 3), dt.datetime(2008, 1, 5), None]


def test_headered_csv_case_clash_keeps_first(spark, tmp_path):
    p = tmp_path / "feat.csv"
    p.write_text("id,Dist_Sum,VALOR,DIST_SUM,Canal\n1,,10.5,7,POS\n2,3.5,11,8,ATM\n", encoding="utf-8")
    df = read_headered_csv(spark, str(p))
    assert df.columns == ["ID", "DIST_SUM", "VALOR", "CANAL"]
    assert [tuple(r) for r in df.orderBy("ID").collect()] == [(1, None, 10.5, "POS"), (2, 3.5, 11.0, "ATM")]
    raw = read_headered_csv(spark, str(p), dedup_case=False)
    assert len(raw.columns) == 5


def test_master_projection_keeps_source_order(spark):
    df = spark.createDataFrame([(1, "a", "b", "c", "d")], "z int, `Tipo de central` string, `Nombre visible` string, "
                                                          "`AGENTE (OFEI)` string, `CENTRAL (x…)` string")
    out = project_master(df, ["Nombre visible", "AGENTE (OFEI)", "CENTRAL (x…)", "Tipo de central"],
                         ["Nombre_Agente", "Agente_OFEI", "Central", "Tipo_Central"])
    assert tuple(out.first()) == ("a", "b", "c", "d")  # file order kept, then renamed by position


def test_sinks(spark, tmp_path):
    df = spark.range(0, 50).select(F.col("id"), (F.col("id") * 2).alias("v"))
    single = str(tmp_path / "single")
    export_single_csv(df, single, ["id"])
    parts = glob.glob(os.path.join(single, "part-*.csv"))
    assert len(parts) == 1
    lines = open(parts[0], encoding="utf-8").read().splitlines()
    assert lines[0] == "id,v" and lines[1] == "0,0" and len(lines) == 51
    many = str(tmp_path / "many")
    write_csv(df.repartition(3), many)
    assert spark.read.option("header", True).csv(many).count() == 50
    tbl = str(tmp_path / "tbl")
    insert_select(df, tbl, ["v", "id"])
    insert_select(df, tbl, ["v", "id"])
    back = spark.read.parquet(tbl)
    assert back.columns == ["v", "id"] and back.count() == 100
    ctas = str(tmp_path / "ctas")
    save_table(df.withColumn("bucket", F.col("id") % 5), ctas, partition_by=["bucket"])
    save_table(df.withColumn("bucket", F.col("id") % 5), ctas, partition_by=["bucket"])  # overwrite
    assert spark.read.parquet(ctas).count() == 50


def test_month_layout_prunes(spark, tmp_path):
    df = spark.createDataFrame([(i, dt.datetime(2024, 1 + i % 3, 1 + i % 27, 5)) for i in range(60)],
                               "id int, ts timestamp_ntz")
    path = str(tmp_path / "bymonth")
    layout.write_month_partitioned(df, "ts", path)
    got = layout.read_time_range(spark, path, "ts", dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan
    assert got.count() == df.filter((F.col("ts") >= dt.datetime(2024, 2, 1)) & (F.col("ts") < dt.datetime(2024, 3, 1))).count()


def test_streaming_summary_refresh_matches_batch(spark, tmp_path):
    schema = T.StructType([T.StructField("place", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("temp", T.DoubleType()), T.StructField("wind", T.DoubleType())])
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "summary"), str(tmp_path / "ckpt")
    rows1 = [(i % 3, dt.datetime(2024, 1, 1 + i % 4, i % 24), float(i), None if i % 5 == 0 else 1.5) for i in range(40)]
    rows2 = [(i % 3, dt.datetime(2024, 1, 2 + i % 4, i % 24), float(-i), 2.0) for i in range(30)]
    spark.createDataFrame(rows1, schema).write.mode("append").parquet(src)
    start_summary_refresh(spark, src, schema, out, ckpt, "place", "ts", "temp", "wind").awaitTermination()
    spark.createDataFrame(rows2, schema).write.mode("append").parquet(src)
    start_summary_refresh(spark, src, schema, out, ckpt, "place", "ts", "temp", "wind").awaitTermination()
    # replaying a batch rewrites its own folder only
    streamed = {(r["place"], r["fecha"]): (r["lecturas"], r["temp_prom"], r["viento_prom"])
                for r in read_summary(spark, out, "place").collect()}
    direct_parts = layout.daily_summary_parts(spark.createDataFrame(rows1 + rows2, schema), "place", "ts", "temp", "wind")
    direct = {(r["place"], r["fecha"]): (r["lecturas"], r["temp_prom"], r["viento_prom"])
              for r in layout.summary_averages(direct_parts).collect()}
    assert streamed == direct


def test_local_range_crosses_utc_month_edge(spark, tmp_path):
    """Months are UTC folders, days are local (-05:00): the evening of a local Jan 31 lies in the
    UTC February folder and must still be found."""
    rows = [(1, dt.datetime(2024, 1, 31, 12)), (2, dt.datetime(2024, 2, 1, 3)), (3, dt.datetime(2024, 2, 1, 6))]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    path = str(tmp_path / "edge")
    layout.write_month_partitioned(df, "ts", path)
    local_jan31 = layout.read_time_range(spark, path, "ts", dt.datetime(2024, 1, 31, 5), dt.datetime(2024, 2, 1, 5))
    assert sorted(r["id"] for r in local_jan31.collect()) == [1, 2]


def test_range_sorted_layout_lookup(spark, tmp_path):
    df = spark.createDataFrame([(i % 7, dt.datetime(2024, 1, 1 + i % 28, i % 24), float(i)) for i in range(500)],
                               "place long, ts timestamp_ntz, v double")
    path = str(tmp_path / "sorted")
    layout.write_range_sorted(df, path, "place", "ts")
    got = spark.read.parquet(path).filter((F.col("place") == 3) & (F.col("ts") >= dt.datetime(2024, 1, 10)))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(place,3)" in plan
    want = df.filter((F.col("place") == 3) & (F.col("ts") >= dt.datetime(2024, 1, 10)))
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())
