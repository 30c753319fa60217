"""Loads that fail whatever is read, refreshed summaries, violations by row, identity values, named files, sketches."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F, types as T

from kestrel.functions.temporal import auto_timestamp
from kestrel.operators import layout, model, quality, star, stats
from kestrel.plans import jobs
from kestrel.session import session_setting
from kestrel.sources import lines as L
from kestrel.sources.sinks import export_named_files, insert_with_identity
from kestrel.sources.tables import bulk_load_delimited, bulk_load_with_rejects

LOAD = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("s", T.StringType()), T.StructField("v", T.DecimalType(8, 2)),
                     T.StructField("code", T.VarcharType(3))])
BAD_LINES = ["x|b|3.50|c", "4|d|z|c", "5||7", "\\N|a|1.00|c", "6|a|1.239|c", "7|a|1.00|long", "|a|1.00|c", "8|a|1.00|c|more"]
READS = {"count": lambda df: df.count(), "one column": lambda df: df.select("s").collect(), "aggregate": lambda df: df.agg(F.max("s")).collect(),
         "other column": lambda df: df.agg(F.sum("v")).collect(), "filter": lambda df: df.where("s = 'nothing'").collect(),
         "null filter": lambda df: df.where("k is not null and v > 100").select("s").collect(), "group": lambda df: df.groupBy("s").count().collect(),
         "join": lambda df: df.select("s").join(df.sparkSession.range(1).selectExpr("'a' AS s"), "s").collect()}


@pytest.mark.parametrize("bad", BAD_LINES)
def test_a_bad_line_fails_the_load(spark, tmp_path, bad):
    p = tmp_path / "rows.txt"
    p.write_text("1|a|2.50|abc\n2||\\N|\n" + bad + "\n", encoding="utf-8")
    loaded = bulk_load_delimited(spark, str(p), LOAD)
    for name, read in READS.items():
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            read(loaded)
            print(name)
    good, rejects = bulk_load_with_rejects(spark, str(p), LOAD)
    assert [r["line"] for r in rejects.collect()] == [bad] and good.count() == 2


def test_a_good_file_loads_as_written(spark, tmp_path):
    p = tmp_path / "rows.txt"
    p.write_text("1|a|2.50|abc\n2||\\N|\n3|\\N|7|\\N\n4|\"q|-0.5|é\n", encoding="utf-8")
    want = [(1, "a", "2.50", "abc"), (2, "", "None", ""), (3, None, "7.00", None), (4, '"q', "-0.50", "é")]
    loaded = bulk_load_delimited(spark, str(p), LOAD)
    assert loaded.columns == ["k", "s", "v", "code"] and loaded.schema["v"].dataType == T.DecimalType(8, 2)
    assert [(r["k"], r["s"], str(r["v"]), r["code"]) for r in loaded.orderBy("k").collect()] == want
    good, rejects = bulk_load_with_rejects(spark, str(p), LOAD)
    assert sorted(map(tuple, good.collect())) == sorted(map(tuple, loaded.collect())) and rejects.count() == 0
    (tmp_path / "none.txt").write_text("")
    assert bulk_load_delimited(spark, str(tmp_path / "none.txt"), LOAD).count() == 0


def test_separators_with_a_meaning_in_patterns(spark, tmp_path):
    for k, sep in enumerate(["\t", "^", ".", "||", "\\", "a", "$"]):
        p = tmp_path / f"rows{k}.txt"
        p.write_text(sep.join(["1", "x", "2.50" if sep != "." else "2", "c"]) + "\n")
        assert [tuple(map(str, r)) for r in bulk_load_delimited(spark, str(p), LOAD, sep=sep).collect()] == [("1", "x", "2.50" if sep != "." else "2.00", "c")]


def readings(spark, n=400, seed=2):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "b", None]), dt.datetime(2024, 1, 28) + dt.timedelta(minutes=rng.randrange(9 * 1440)),
             rng.randrange(4000) / 100, None if rng.random() < 0.2 else rng.randrange(900) / 100) for i in range(n)]
    rows += [(n + i, "a", None, 1.0, 1.0) for i in range(3)]
    return spark.createDataFrame(rows, "id long, place string, ts timestamp_ntz, temp double, wind double")


def summary(df):
    return sorted((tuple(map(str, r)) for r in df.select("place", F.col("fecha").cast("date"), "suma_temp", "suma_viento", "lecturas", "n_viento").collect()))


@pytest.mark.parametrize("months", [True, False])
def test_refresh_equals_a_full_recompute(spark, tmp_path, months):
    all_rows, base, path = readings(spark), str(tmp_path / "base"), str(tmp_path / "summary")
    args = ("place", "ts", "temp", "wind", "-05:00")
    day = F.dayofmonth(F.col("ts") - F.expr("INTERVAL 5 HOURS"))
    late = F.coalesce(day.isin(30, 31, 1), F.lit(False)) & (F.col("id") % 3 == 0)
    new_day = F.coalesce(day == 4, F.lit(False))
    put = (lambda df, mode: layout.write_month_partitioned(df, "ts", base, mode)) if months else (lambda df, mode: df.write.mode(mode).parquet(base))
    put(all_rows.where(~late & ~new_day), "overwrite")
    layout.write_summary(layout.daily_summary_parts(spark.read.parquet(base), *args), path, place="place")
    old = {os.path.join(p, f) for p, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    for batch in (all_rows.where(late & (F.col("id") % 2 == 0)), all_rows.where((late & (F.col("id") % 2 == 1)) | new_day)):
        put(batch, "append")
        for _ in range(2):  # a refresh that runs again changes nothing
            layout.refresh_summary(spark.read.parquet(base), batch, path, *args)
    assert summary(spark.read.parquet(path)) == summary(layout.daily_summary_parts(all_rows, *args))
    now = {os.path.join(p, f) for p, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    changed = {p.split("fecha=")[1].split("/")[0] for p in now ^ old}
    assert changed == {"2024-01-30", "2024-01-31", "2024-02-01", "2024-02-04"}


def test_a_local_month_reads_two_folders(spark, tmp_path):
    rows = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2023-11-15', TIMESTAMP_NTZ'2024-03-15', INTERVAL 6 HOURS)) AS ts")
    layout.write_month_partitioned(rows, "ts", str(tmp_path / "m"))
    for month, offset, folders in ((12, "-05:00", 2), (1, "-05:00", 2), (2, "+05:30", 2), (2, "+00:00", 1)):
        got = layout.read_local_month(spark, str(tmp_path / "m"), "ts", 2023 if month == 12 else 2024, month, offset)
        sign = {"-": "- INTERVAL 5 HOURS", "+": "+ INTERVAL '5:30' HOUR TO MINUTE"}[offset[0]] if offset != "+00:00" else ""
        want = rows.where(F.expr(f"month(ts {sign}) = {month}"))
        assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in want.collect()) and got.count() > 100
        plan = got._jdf.queryExecution().explainString(got.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert "PartitionFilters: [isnotnull(month" in plan
        read = got.select(F.input_file_name().alias("f")).where("f != ''")
        assert len({r["f"].split("month=")[1][:7] for r in read.distinct().collect()}) <= folders


def test_violations_name_rows_and_rules(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", -1.0), (3, None, None), (4, None, 5.0), (5, "b", 1.0), (6, "toolong", 1e9)], "id int, s string, x double")
    q = quality
    rules = [q.not_null("s"), q.domain("s", ["a", "b"], allow_null=True), q.non_negative("x"), q.max_length("s", 3), q.decimal_fit("x", 8, 2), q.unique("s"), q.unique("s", "x")]
    got = sorted((r["check_name"], r["column_name"], r["id"]) for r in q.violations(df, "t", rules, ["id"]).collect())
    assert got == sorted([("not_null", "s", 3), ("not_null", "s", 4), ("domain", "s", 6), ("non_negative", "x", 2), ("max_length", "s", 6),
                          ("decimal_fit", "x", 6), ("unique", "s", 1), ("unique", "s", 2), ("unique", "s", 3), ("unique", "s", 4)])
    counts = {(r["check_name"], r["column_name"]): r["violations"] for r in q.quality_report(df, "t", rules).collect()}
    for rule in rules[:5]:
        assert counts[rule.name, rule.column_label] == sum(g[:2] == (rule.name, rule.column_label) for g in got)
    assert q.violations(df.limit(0), "t", rules, ["id"]).count() == 0


def test_identity_goes_on_after_the_stored_maximum(spark, tmp_path):
    path, total = str(tmp_path / "t"), 0
    for k, n in enumerate([1000, 0, 1, 357]):
        rows = spark.range(n).select((F.col("id") + k * 10_000).alias("v")).repartition(7)
        insert_with_identity(rows.where("v % 2 = 0"), path, "sk")
        stored = spark.read.parquet(path)
        added = stored.where(F.col("v") >= k * 10_000).select("sk").collect()
        assert sorted(r["sk"] for r in added) == list(range(total + 1, total + 1 + len(added)))
        total += len(added)
    assert stored.select("sk").distinct().count() == stored.count() == total == 500 + 1 + 179
    one = spark.createDataFrame([(5, "a"), (6, "b")], "v int, p string")
    insert_with_identity(one, str(tmp_path / "p"), "sk", partition_by=["p"])
    assert {(r["sk"], r["v"], r["p"]) for r in spark.read.parquet(str(tmp_path / "p")).collect()} in ({(1, 5, "a"), (2, 6, "b")}, {(2, 5, "a"), (1, 6, "b")})


def test_named_files(spark, tmp_path):
    prefix = str(tmp_path / "out_")
    df = spark.range(10).select(F.col("id"), (F.lit(100) - F.col("id")).alias("v"))
    (tmp_path / "out_000").write_text("old")
    assert export_named_files(df, prefix, ["v"]) == [prefix + "000"]
    assert (tmp_path / "out_000").read_text().split() == ["id,v", *[f"{i},{100 - i}" for i in range(9, -1, -1)]]
    assert export_named_files(df, prefix, [F.col("id")], max_records=4) == [prefix + f"00{k}" for k in range(3)]
    assert [(tmp_path / f"out_00{k}").read_text().split()[1:] for k in range(3)] == [[f"{i},{100 - i}" for i in r] for r in (range(4), range(4, 8), range(8, 10))]
    assert export_named_files(df.limit(0), str(tmp_path / "none_")) == [str(tmp_path / "none_000")]
    assert (tmp_path / "none_000").read_text().split() == ["id,v"]
    assert not [f for f in os.listdir(tmp_path) if "unload" in f and not f.endswith(".crc")]


def test_stored_sketches_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.col("id") % 2).alias("g"), F.hash("id").cast("double").alias("x"), (F.col("id") % 4001).alias("u"))
    parts = stats.sketch_parts(df, ["g", "day"], "x", "u")
    for q in (0.1, 0.5, 0.9):
        for r in stats.sketch_estimates(stats.merge_sketch_parts(parts, ["g"]), q).collect():
            rows = df.where(F.col("g") == r["g"])
            assert abs(rows.where(F.col("x") <= r["quantile"]).count() / r["n"] - q) < 0.01 and r["n"] == 30_000
            assert abs(r["n_distinct"] / 4001 - 1) < 0.03
    nulls = spark.createDataFrame([(1, None, None), (1, 2.0, "a"), (2, None, None)], "g int, x double, u string")
    got = {r["g"]: (r["n"], r["n_distinct"]) for r in stats.merge_sketch_parts(stats.sketch_parts(nulls, ["g"], "x", "u"), ["g"]).select(
        "g", "n", F.hll_sketch_estimate("hll").alias("n_distinct")).collect()}
    assert got == {1: (2, 1), 2: (1, 0)}


def test_consolidation_by_ids_equals_that_by_names(spark):
    rng = random.Random(4)
    fact = spark.createDataFrame([(rng.randrange(12), rng.randrange(9), dt.date(2024, 1, rng.randrange(1, 4)), rng.randrange(900) / 100) for _ in range(500)]
                                 + [(None, 1, None, 1.0), (99, 1, dt.date(2024, 1, 1), 1.0)], "u int, e int, d date, x double")
    users = spark.createDataFrame([(i, ["ann", "bob", None][i % 3], "mail" if i < 6 else None) for i in range(12)], "uid int, name string, mail string")
    events = spark.createDataFrame([(i, f"event {i % 4}") for i in range(8)], "eid int, title string")
    plain = star.consolidate(fact, [(users, F.col("u") == F.col("uid")), (events, F.col("e") == F.col("eid"))],
                             ["name", "mail", "title", F.col("d").alias("day")], [F.sum(F.col("x").cast("decimal(10,2)")).alias("x"), F.count("*").alias("n")])
    by_ids = star.consolidate_by_ids(fact, [star.Names(users, "uid", "u", {"name": "name", "mail": "mail"}), star.Names(events, "eid", "e", {"title": "title"})],
                                     {"day": "d"}, [F.sum(F.col("x").cast("decimal(10,2)")).alias("x"), F.count("*").alias("n")])
    rows = lambda df: sorted(map(str, df.select("name", "mail", "title", "day", "x", "n").collect()))
    assert rows(by_ids) == rows(plain)


@pytest.mark.parametrize("split", [64, 300, 5000])
def test_sections_go_on_over_splits(spark, tmp_path, split):
    rng, want = random.Random(split), []
    for k in range(3):
        section, text = None, []
        for i in range(200):
            if rng.random() < 0.1:
                section = f"s{i} {'x' * rng.randrange(60)}".strip()
                text.append(f" Agente: {section}  ")
            else:
                text.append(f"{k},{i},{'y' * rng.randrange(30)}")
                want.append((k, i, section))
        (tmp_path / f"part{k}.txt").write_text("\n".join(text) + "\n")
    with session_setting(spark, "spark.sql.files.maxPartitionBytes", str(split)):
        got = L.attach_sections(L.read_lines(spark, str(tmp_path)), "AGENTE:", columns=["line"]).collect()
    assert sorted((int(r["line"].split(",")[0]), int(r["line"].split(",")[1]), r["section"]) for r in got) == want


def test_auc_by_group(spark):
    rng = random.Random(9)
    rows = spark.createDataFrame([(f, rng.randrange(2), rng.randrange(20) / 20) for f in (0, 1, 2) for _ in range(100)] + [(3, 1, 0.5)], "fold int, y int, p double")
    got = {r["fold"]: r["auc"] for r in model.auc_by(rows, "fold", "y", "p").collect()}
    for f in range(4):
        assert got[f] == model.auc(rows.where(F.col("fold") == f), "y", "p").first()["auc"]
    assert got[3] is None


def test_more_timestamp_shapes(spark):
    at = dt.datetime(2024, 3, 5, 6, 7)
    forms = {"2024-03-05T06:07:00.123456": at.replace(microsecond=123456), "3-5-2024 06:07": at, "2024/03/05 6:07:00": at, "mar 5 2024 6:07 a.m.": at,
             "MAY 5, 2024": dt.datetime(2024, 5, 5), "5 may 2024 12:00 PM": dt.datetime(2024, 5, 5, 12), "September 30, 2024 11:59:59 pm": dt.datetime(2024, 9, 30, 23, 59, 59),
             "20240305 060700": at, "20240305T060700": at, " 2024-03-05  06:07 ": at, "2024-03-05 06:07AM": at,
             "2024-02-30": None, "2024-13-01": None, "2024-03-05 25:00": None, "13:05": None, "2024-03-05 13:00 PM": None, "2024-3-5": None, "12/31/99": None,
             "2024-03-05 06:07:00.1234567": None, "x" * 5000: None, "31 foo 2024": None}
    got = spark.createDataFrame([(k,) for k in forms], "s string").select("s", auto_timestamp("s").alias("t")).collect()
    assert {r["s"]: r["t"] for r in got} == forms


def test_unload_of_the_consolidation(spark, tmp_path):
    rows = spark.createDataFrame([("a", 5), ("b", 9), ("c", 7)], "nombre_evento string, total_vendido int")
    names = jobs.ticket_unload(rows, str(tmp_path / "ventas_"), max_records=2)
    assert [open(n).read().split() for n in names] == [["nombre_evento,total_vendido", "b,9", "c,7"], ["nombre_evento,total_vendido", "a,5"]]


def test_a_master_row_that_passes_by_position(spark, tmp_path):
    """The kept columns stay in file order and take the new names by position: the agent may stand in the second."""
    cols = ["Tipo de central (Hidro, Termo, Filo, Menor)", "Nombre visible Agente", "AGENTE (OFEI)", "CENTRAL (dDEC, dSEGDES, dPRU…)"]
    m, d = tmp_path / "master.csv", tmp_path / "ddec.txt"
    m.write_text("\n".join(",".join(f'"{v}"' for v in r) for r in [cols, ["x", "EMGESA", "PLANT_A", "H"], ["x", "OTRO", "PLANT_A", "H"]]) + "\n", encoding="utf-8")
    d.write_text("PLANT_A," + ",".join(["2"] * 24), encoding="utf-8")
    got = [(r["Nombre_Agente"], r["Agente_OFEI"], r["Tipo_Central"], r["Suma_Horas"]) for r in jobs.declarations_job(spark, str(m), str(d)).collect()]
    assert got == [("x", "EMGESA", "H", 48.0)]
