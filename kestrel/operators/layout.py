"""Stored layouts: month partitions, range-sorted and bucketed tables, mergeable daily summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from kestrel.functions.numeric import round_half_up
from kestrel.functions.temporal import local_date, offset_seconds
from kestrel.session import written

MONTH_COL = "month"


def month_of(ts: str):
    """UTC month key 'yyyy-MM' (months start at 00:00 UTC, whatever the session's zone)."""
    return F.date_format(local_date(ts, "+00:00"), "yyyy-MM")


def write_month_partitioned(df: DataFrame, ts: str, path: str, mode: str = "overwrite") -> None:
    """K5: one folder per UTC month; a predicate on ``month`` prunes folders at planning.

    Rows are range partitioned on (month, ts) before the write: each task writes into one or two
    month folders (few files), and a month holding most rows is still split over many tasks.
    """
    (df.withColumn(MONTH_COL, month_of(ts))
       .repartitionByRange(F.col(MONTH_COL), F.col(ts))
       .write.mode(mode).partitionBy(MONTH_COL).parquet(path))


def read_time_range(spark: SparkSession, path: str, ts: str, lo: dt.datetime, hi: dt.datetime) -> DataFrame:
    """Rows with lo <= ts < hi from a month-partitioned table.

    A predicate on ``ts`` alone does not prune a derived partition column, so the month range is
    added as a second predicate (partition filter) next to the exact one (pushed to Parquet).
    """
    last = hi - dt.timedelta(microseconds=1)
    lo_m, hi_m = lo.strftime("%Y-%m"), last.strftime("%Y-%m")
    df = spark.read.parquet(path)
    return (df.filter((F.col(MONTH_COL) >= lo_m) & (F.col(MONTH_COL) <= hi_m))
              .filter((F.col(ts) >= F.lit(lo)) & (F.col(ts) < F.lit(hi)))
              .drop(MONTH_COL))


def read_local_month(spark: SparkSession, path: str, ts: str, year: int, month: int, offset: str = "-05:00") -> DataFrame:
    """K5: the rows of a calendar month as seen at a fixed offset, from a table of UTC months.

    Such a month begins and ends inside UTC months, so two folders at most are read, and the instants of
    its ends are pushed to the files of those.
    """
    away = dt.timedelta(seconds=offset_seconds(offset))
    first, after = dt.datetime(year, month, 1), dt.datetime(year + month // 12, month % 12 + 1, 1)
    return read_time_range(spark, path, ts, first - away, after - away)


def write_range_sorted(df: DataFrame, path: str, key: str, ts: str, mode: str = "overwrite") -> None:
    """K6, file form: range partitions on key, sorted by (key, ts) inside each file, so Parquet
    row-group min/max statistics skip everything outside a (key, time-range) lookup."""
    (df.repartitionByRange(F.col(key), F.col(ts))
       .sortWithinPartitions(key, ts)
       .write.mode(mode).parquet(path))


def write_bucketed(df: DataFrame, table: str, path: str, key: str, ts: str, buckets: int,
                   mode: str = "overwrite", files_per_bucket: int = 1) -> None:
    """K6, table form: ``bucketBy(key).sortBy(ts)``; aggregations and joins on ``key`` read it
    without an exchange.

    Rows are dealt to the writers by bucket, and within a bucket by the time's hash to
    ``files_per_bucket`` files: a bucket never has more files than that, however many tasks write. A
    key that holds much of the rows is still read by one task; ``write_range_sorted`` has no such limit.
    """
    bucket = F.pmod(F.hash(F.col(key)), F.lit(buckets))
    part = F.pmod(F.xxhash64(F.col(ts)), F.lit(files_per_bucket))
    (df.repartition(buckets * files_per_bucket, bucket, part)
       .write.mode(mode).bucketBy(buckets, key).sortBy(ts)
       .option("path", path).format("parquet").saveAsTable(table))


def daily_summary_parts(df: DataFrame, place: str, ts: str, temp: str, wind: str,
                        offset: str = "-05:00", date_col: str = "fecha") -> DataFrame:
    """Mergeable daily parts per (place, local day): sums and counts only.

    ``suma_viento`` counts a missing wind as 0 and ``lecturas`` counts all readings; ``n_viento``
    counts present winds so the ignore-missing average can be derived as well.
    """
    dec = "decimal(18,2)"
    return (df.groupBy(place, local_date(ts, offset).alias(date_col))
              .agg(F.sum(F.col(temp).cast(dec)).alias("suma_temp"),
                   F.sum(F.coalesce(F.col(wind).cast(dec), F.lit(0).cast(dec))).alias("suma_viento"),
                   F.count(F.lit(1)).alias("lecturas"),
                   F.count(wind).alias("n_viento")))


def merge_summary_parts(parts: DataFrame, place: str, date_col: str = "fecha") -> DataFrame:
    """Parts are sums and counts, so they merge by adding (used by incremental refresh)."""
    return (parts.groupBy(place, date_col)
                 .agg(*[F.sum(c).alias(c) for c in ("suma_temp", "suma_viento", "lecturas", "n_viento")]))


def write_summary(parts: DataFrame, path: str, date_col: str = "fecha", place: str | None = None) -> None:
    """Store parts by day; a refresh rewrites only the days it carries (dynamic overwrite).

    Range partitioning on (day[, place]) keeps each task to few day folders without sending a busy
    day to a single task.
    """
    keys = [F.col(date_col)] + ([F.col(place)] if place else [])
    (parts.repartitionByRange(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy(date_col).parquet(path))


def refresh_summary(readings: DataFrame, late: DataFrame, path: str, place: str, ts: str, temp: str, wind: str,
                    offset: str = "-05:00", date_col: str = "fecha") -> None:
    """K7: bring a stored summary up to date after ``late`` rows were added to ``readings`` (which holds them).

    The (place, day) keys that the late rows touch are worked out again from all their readings, found by a
    semi join; the other keys of the touched days come from the store. Only the folders of these days are
    written. Nothing is added to stored numbers, so a refresh that runs twice, or again after a failure,
    leaves the same summary. Where ``readings`` is a table of UTC months, only the months of the touched days
    are read; rows without a time are of no month and no day, and stay as they were first summed up.
    """
    spark = readings.sparkSession
    day = local_date(ts, offset)
    keys = written(late.select(F.col(place).alias("__place"), day.alias("__day")).where("__day is not null").distinct(), "touched")
    same = F.col(place).eqNullSafe(F.col("__place")) & day.eqNullSafe(F.col("__day"))
    if MONTH_COL in readings.columns:  # a table of UTC months: a local day's readings lie in those of its two ends
        start = F.col("__day").cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(offset_seconds(offset)))
        ends = F.array(*[F.date_format(t, "yyyy-MM") for t in (start, start + F.expr("INTERVAL '86399.999999' SECOND"))])
        readings = readings.join(keys.select(F.explode(ends).alias(MONTH_COL)).distinct(), MONTH_COL, "left_semi")
    again = daily_summary_parts(readings.join(keys, same, "left_semi"), place, ts, temp, wind, offset, date_col)
    stored = spark.read.parquet(path)
    stored = stored.withColumn(date_col, F.col(date_col).cast("date"))
    days = keys.select("__day").distinct()
    of_days = stored.join(days, F.col(date_col).eqNullSafe(F.col("__day")), "left_semi")
    kept = of_days.join(keys, F.col(place).eqNullSafe(F.col("__place")) & F.col(date_col).eqNullSafe(F.col("__day")), "left_anti")
    # the days are read and replaced in the same store, so the new rows are complete before the first file goes
    write_summary(written(again.unionByName(kept), "refreshed"), path, date_col, place)


def summary_averages(parts: DataFrame) -> DataFrame:
    """A10: averages derived at read: round(sum / count, 2); wind both as null-as-zero and as
    ignore-null."""
    s_t, s_w = F.col("suma_temp").cast("double"), F.col("suma_viento").cast("double")
    return parts.select(
        "*",
        round_half_up(F.try_divide(s_t, F.col("lecturas"))).alias("temp_prom"),
        round_half_up(F.try_divide(s_w, F.col("lecturas"))).alias("viento_prom_cero"),
        round_half_up(F.try_divide(s_w, F.col("n_viento"))).alias("viento_prom"),
    )
