"""Helpers shared by the operators: tables cut from their lineage, Arrow row iteration, exact pre-filters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import written

#: Distinct values a broadcast pre-filter can hold, whatever the data size (see ``keep_buckets``).
FILTER_BUCKETS = 1 << 20
#: Bits of a map of wanted hashes, as a power of two: 512 KB, whatever the data size (see ``bit_map``).
MAP_BITS = 22


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_buckets(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """Rows of ``df`` whose key falls in a hash bucket that holds a wanted key.

    At most ``FILTER_BUCKETS`` distinct longs are broadcast, however many wanted keys there are. The
    filter passes every wanted row and some others, so an exact join must follow; it only spares
    that join the rows that cannot match.
    """
    return _by_bucket(df, key, wanted, wanted_key, "left_semi")


def other_buckets(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """The rows that ``keep_buckets`` leaves out: none of them has a wanted key."""
    return _by_bucket(df, key, wanted, wanted_key, "left_anti")


def _by_bucket(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, how: str) -> DataFrame:
    def bucket(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(FILTER_BUCKETS))

    hit = wanted.select(bucket(wanted_key).alias("__bucket")).distinct()
    left = df.select(F.struct("*").alias("__row"), bucket(key).alias("__bucket"))
    return left.join(F.broadcast(hit), "__bucket", how).select("__row.*")


def bit_map(hashes: DataFrame, column: str) -> np.ndarray:
    """2 ** MAP_BITS bits, packed: those of the hashes' first bits are set. Spark builds it in 128 parts."""
    at = F.shiftrightunsigned(column, 64 - MAP_BITS) + 1
    parts = (hashes.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect())
    out = np.zeros((1 << MAP_BITS) // 8, dtype=np.uint8)
    for r in parts:
        lo = (r["part"] - 1) * 4096
        out[lo:lo + len(r["bits"])] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - MAP_BITS)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0


def rows_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    out = []
    for x in batch.column(batch.schema.get_field_index(name)):
        b = x.as_buffer() if x.is_valid else None
        out.append(b.to_pybytes() if b is not None else b"")
    return out


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn`` over every Arrow batch, large batches cut so that a task holds a few MB of text at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, min(batch.num_rows, int(batch.num_rows * (2 << 20) / max(1, batch.nbytes))))
            for at in range(0, batch.num_rows, step):
                yield from fn(batch.slice(at, step))

    return df.mapInArrow(run, schema)
