"""Sinks: CSV with header, single-file export, create-table-as-select, insert-select."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from kestrel.session import written


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",") -> None:
    """K1: CSV with a header row and no index column, UTF-8 (no byte-order mark), in parallel."""
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def export_single_csv(df: DataFrame, path: str, order_by: Sequence[str | Column] = (), mode: str = "overwrite") -> None:
    """K2: one CSV part file with a header, overwriting the target.

    ``repartition(1)`` (not ``coalesce(1)``) keeps the query upstream parallel; only the final
    sort and write run in one task, as a single-writer export requires.
    """
    out = df.repartition(1)
    if order_by:
        out = out.sortWithinPartitions(*order_by)
    out.write.mode(mode).option("header", True).csv(path)


def export_named_files(df: DataFrame, prefix: str, order_by: Sequence[str | Column] = (), max_records: int = 0) -> list[str]:
    """K2: ``<prefix>000``, one CSV file with a header; files of that name are replaced, and the names returned.

    With ``max_records`` a file ends after so many rows and ``<prefix>001`` goes on, in order. Spark writes and
    commits the files in a folder beside the target, so a task that fails or runs twice leaves nothing there;
    each is then renamed over the target by the file system, in one step where it has such a rename.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs
    staging = fs.Path(f"{prefix}-{uuid.uuid4().hex[:12]}.unload")
    out = df.repartition(1)
    if order_by:
        out = out.sortWithinPartitions(*order_by)
    (out.write.option("header", True).option("maxRecordsPerFile", max_records).csv(staging.toString()))
    store = staging.getFileSystem(conf)
    found = sorted((f.getPath() for f in store.listStatus(staging) if f.getPath().getName().startswith("part-")), key=lambda x: x.getName())
    context = fs.FileContext.getFileContext(store.makeQualified(staging).toUri(), conf)
    over = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    over[0] = getattr(fs, "Options$Rename").OVERWRITE
    names = []
    for k, part in enumerate(found):
        target = fs.Path(f"{prefix}{k:03d}")
        context.rename(store.makeQualified(part), store.makeQualified(target), over)
        names.append(target.toString())
    store.delete(staging, True)
    return names


def insert_with_identity(df: DataFrame, path: str, id_col: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows to a stored table, numbering them on from its largest ``id_col`` (from 1 in a new table).

    Rows are numbered task by task: a task's rows follow those of the tasks before it, so one count for each
    task is all that is summed up; nothing is sorted or moved. The rows are stored with their places first, so
    a task that runs again gives the same numbers. One insert at a time, as the largest number is read first.
    """
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    base = (spark.read.parquet(path).agg(F.max(id_col)).first()[0] if exists else None) or 0
    place = F.monotonically_increasing_id()
    staged = written(df.withColumn("__place", place), "insert")
    task, at = F.shiftright("__place", 33), F.col("__place").bitwiseAND((1 << 33) - 1)
    before = F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    counts = staged.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).select("task", F.coalesce(before, F.lit(0)).alias("__before"))
    # one row for each task that wrote the staged rows: small enough to broadcast, whatever the rows' number
    numbered = staged.join(F.broadcast(counts), task == F.col("task"), "inner")
    number = F.lit(base).cast("long") + F.col("__before") + at + 1
    w = numbered.select(number.alias(id_col), *[F.col(f"`{c}`") for c in df.columns]).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """K3: store a query result as a Parquet table (no order is kept once stored)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def insert_select(df: DataFrame, path: str, columns: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """K4: append the listed columns, in that order, to a stored table."""
    w = df.select(*columns).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
