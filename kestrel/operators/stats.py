"""Descriptive statistics: exact median/percentiles, mode with frequency, shares, one-row reports.

The exact percentile never gathers values in one task: values are counted per distinct value (a
partial aggregate), the counts are turned into cumulative ranks by an ordered scan, and only the
one or two distinct values that hold the wanted ranks are picked. The mode comes from the same
value counts with a top-1 (``TakeOrderedAndProject``: one candidate per task).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from kestrel.functions.numeric import exact_sum, round_half_up
from kestrel.operators.ordered import ordered_scan
from kestrel.session import written


def value_counts(df: DataFrame, col: str, count_col: str = "frequency") -> DataFrame:
    """A2/A9 building block: (value, count) for non-null values."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(count_col))


def exact_percentile(df: DataFrame, col: str, q: float = 0.5, out: str = "median") -> DataFrame:
    """``percentile_cont(q) WITHIN GROUP (ORDER BY col)`` as a one-row frame (nulls ignored).

    Linear interpolation between the values at 0-based ranks floor(p) and ceil(p), p = q*(n-1),
    written as lo + (hi - lo) * frac.
    """
    return percentile_of_counts(written(value_counts(df, col, "__n"), "values"), col, "__n", q, out)


def percentile_of_counts(vc: DataFrame, col: str, count_col: str, q: float = 0.5, out: str = "median") -> DataFrame:
    """A8 from stored value counts (``value_counts``), which may serve a mode as well."""
    vc = vc.withColumnRenamed(count_col, "__n")
    n = vc.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    if n == 0:
        return vc.agg(F.lit(None).cast("double").alias(out))
    cum = ordered_scan(vc, [], [col], [("cumsum", "__n", "__cum")])
    pos = q * (n - 1)
    lo, hi = math.floor(pos), math.ceil(pos)
    frac = pos - lo
    first_rank = F.col("__cum") - F.col("__n")  # 0-based rank of the value's first copy

    def at(rank: int) -> Column:
        return F.min(F.when((first_rank <= rank) & (F.col("__cum") > rank), F.col(col).cast("double")))

    lo_v, hi_v = at(lo), at(hi)
    value = lo_v if lo == hi else lo_v + (hi_v - lo_v) * F.lit(frac)
    return cum.agg(value.alias(out))


def exact_median(df: DataFrame, col: str, out: str = "median") -> DataFrame:
    return exact_percentile(df, col, 0.5, out)


def _stacked_counts(df: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    """(name, value, n): counts of the non-null values of several columns, in one pass over ``df``."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast(kind).alias("value")) for c in cols]))
    return (df.select(pairs.alias("p")).select("p.*").where(F.col("value").isNotNull())
            .groupBy("name", "value").agg(F.count(F.lit(1)).alias("n")))


def exact_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """A8 for several columns at once: one value count and one ordered scan keyed by column."""
    vc = written(_stacked_counts(df, cols, "double"), "values")
    total = vc.groupBy(F.col("name").alias("__name")).agg(F.sum("n").alias("total"))
    cum = ordered_scan(vc, ["name"], ["value"], [("cumsum", "n", "upto")]).join(total, F.col("name") == F.col("__name"))
    lo, hi = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)  # 0-based ranks of the middle

    def at(rank: Column) -> Column:
        return F.min(F.when((F.col("upto") - F.col("n") <= rank) & (F.col("upto") > rank), F.col("value")))

    rows = cum.groupBy("name").agg(at(lo).alias("lo"), at(hi).alias("hi")).collect()  # one row per column
    return {r["name"]: r["lo"] + (r["hi"] - r["lo"]) * 0.5 if r["lo"] != r["hi"] else r["lo"] for r in rows}


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """A9 for several text columns at once: the most frequent value of each, ties to the smallest."""
    best = F.min(F.struct((-F.col("n")).alias("n"), "value")).getField("value").alias("value")
    return {r["name"]: r["value"] for r in _stacked_counts(df, cols, "string").groupBy("name").agg(best).collect()}


def mode_with_frequency(df: DataFrame, col: str, out: str = "mode", freq: str = "frequency") -> DataFrame:
    """Most frequent non-null value and its count; ties go to the smallest value."""
    return mode_of_counts(value_counts(df, col, freq), col, freq, out, freq)


def mode_of_counts(vc: DataFrame, col: str, count_col: str, out: str = "mode", freq: str = "frequency") -> DataFrame:
    """A9 from value counts."""
    return vc.orderBy(F.col(count_col).desc(), F.col(col).asc()).limit(1).select(F.col(col).alias(out), F.col(count_col).alias(freq))


def describe(df: DataFrame, col: str, prefix: str = "") -> DataFrame:
    """Rounded average and sample standard deviation, min, max, row count.

    The average is the exact sum (see ``exact_sum``) over the count.
    """
    c = F.col(col)
    return df.agg(
        round_half_up(F.try_divide(exact_sum(c), F.count(c))).alias(f"{prefix}avg"),
        round_half_up(F.stddev_samp(c)).alias(f"{prefix}stddev"),
        F.min(c).alias(f"{prefix}min"),
        F.max(c).alias(f"{prefix}max"),
        F.count(F.lit(1)).alias(f"{prefix}count"),
    )


def class_shares(df: DataFrame, label: str, count_col: str = "n", share_col: str = "share") -> DataFrame:
    """Count per class and its share of all rows. The classes' total is one number, taken first."""
    counts = written(df.groupBy(label).agg(F.count(F.lit(1)).alias(count_col)), "classes")
    total = counts.agg(F.sum(count_col)).first()[0]
    return counts.withColumn(share_col, F.col(count_col) / F.lit(total))


def one_row(frames: Sequence[DataFrame]) -> DataFrame:
    """J6 without a cross join: one-row frames with distinct columns put side by side.

    The frames are stacked (``unionByName`` with missing columns as null) and collapsed with
    ``first(ignorenulls)`` per column.
    """
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    cols = []
    for f in frames:
        cols.extend(f.columns)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


def approx_percentile(df: DataFrame, col: str, q: float = 0.5, out: str = "p", accuracy: int = 10_000) -> DataFrame:
    """A8 opt-in: one-pass sketch (``percentile_approx``) returning an actual value of the column
    within rank error 1/accuracy; no interpolation. For very large inputs where an exact answer is
    not required."""
    return df.agg(F.percentile_approx(F.col(col), q, accuracy).alias(out))


def distinct_count(df: DataFrame, col: str, out: str = "n_distinct", approx: bool = False,
                   rsd: float = 0.05) -> DataFrame:
    """A2: number of distinct non-null values; ``approx=True`` uses a HyperLogLog++ sketch
    (``approx_count_distinct``, relative standard deviation ``rsd``) instead of an exact distinct."""
    c = F.approx_count_distinct(col, rsd) if approx else F.count_distinct(col)
    return df.agg(c.alias(out))


#: Size parameters of stored sketches: the rank error of KLL falls with k, the error of HLL with 2^(lg_k / 2).
KLL_K, HLL_LG_K = 400, 14


def sketch_parts(df: DataFrame, keys: Sequence[str], value: str, distinct: str) -> DataFrame:
    """A8/A2 as parts to store: for each group, rows, a KLL sketch of a numeric column and an HLL sketch of another.

    Parts of any grouping merge with ``merge_sketch_parts``: a summary by day gives quantiles and numbers of
    distinct values by month or in all, which medians and counts by day could not. Nulls are in neither sketch.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(KLL_K)).alias("kll"),
                                 F.hll_sketch_agg(F.col(distinct), HLL_LG_K).alias("hll"))


def merge_sketch_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored parts of finer groups merged to the groups of ``keys``."""
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double(F.col("kll")).alias("kll"),
                                    F.hll_union_agg("hll").alias("hll"))


def sketch_estimates(parts: DataFrame, q: float = 0.5, out: str = "quantile", distinct_out: str = "n_distinct") -> DataFrame:
    """The quantile and the number of distinct values that parts stand for, in place of the sketches."""
    return parts.withColumn(out, F.kll_sketch_get_quantile_double("kll", F.lit(q))).withColumn(
        distinct_out, F.hll_sketch_estimate("hll")).drop("kll", "hll")
