"""Incremental maintenance of the stored daily summary (K7) with Structured Streaming.

New hourly readings arriving as files are turned, per micro-batch, into mergeable daily parts
(sums and counts) and stored under ``batch_id=<id>/fecha=<day>``. A replayed micro-batch rewrites
its own folder, so the result is exactly-once even though ``foreachBatch`` is at-least-once.
Readers merge parts by adding them (``merge_summary_parts``) and derive averages at read time;
``compact`` folds all batch folders into one when they grow many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from kestrel.operators.layout import daily_summary_parts, merge_summary_parts, summary_averages


def start_summary_refresh(spark: SparkSession, source_path: str, schema: T.StructType, summary_path: str,
                          checkpoint_path: str, place: str, ts: str, temp: str, wind: str,
                          offset: str = "-05:00", available_now: bool = True,
                          max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the refresh; with ``available_now`` it processes what is there and stops."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_path)

    def write_parts(batch: DataFrame, batch_id: int) -> None:
        parts = daily_summary_parts(batch, place, ts, temp, wind, offset)
        (parts.write.mode("overwrite").partitionBy("fecha")
              .parquet(f"{summary_path.rstrip('/')}/batch_id={batch_id}"))

    w = stream.writeStream.foreachBatch(write_parts).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_summary(spark: SparkSession, summary_path: str, place: str) -> DataFrame:
    """Merged parts with averages derived at read."""
    parts = spark.read.parquet(summary_path).withColumn("fecha", F.col("fecha").cast("date"))
    return summary_averages(merge_summary_parts(parts, place))


def compact(spark: SparkSession, summary_path: str, target_path: str, place: str) -> None:
    """Fold all batch folders into one set of parts (run while the refresh is stopped)."""
    parts = spark.read.parquet(summary_path).withColumn("fecha", F.col("fecha").cast("date"))
    merge_summary_parts(parts, place).write.mode("overwrite").partitionBy("fecha").parquet(target_path)
