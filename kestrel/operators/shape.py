"""Column-set tools, keep-first dedup, wide/long reshaping, row totals."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from kestrel.functions.numeric import row_total
from kestrel.functions.text import ustrip


def normalized_in(c: Column | str, values: Iterable[str]) -> Column:
    """stripped, upper-cased value is in the set; null is never in it (false, not null)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.upper(ustrip(c)).isin([v.upper() for v in values]), F.lit(False))


def filter_by_sets(df: DataFrame, any_of: Sequence[tuple[str, Iterable[str]]],
                   all_of: Sequence[tuple[str, Iterable[str]]] = ()) -> DataFrame:
    """(col1 in S1 OR col2 in S2 ...) AND (colK in SK ...), each test normalised."""
    cond = None
    for c, vals in any_of:
        t = normalized_in(c, list(vals))
        cond = t if cond is None else (cond | t)
    for c, vals in all_of:
        t = normalized_in(c, list(vals))
        cond = t if cond is None else (cond & t)
    return df if cond is None else df.filter(cond)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order`` (file order), null keys forming one key.

    Done as ``min(struct(order..., rest...))`` per key: each task sorts and reduces its own rows before
    the shuffle, so a key holding a third of the rows costs one row per task after it.
    Column order of the input is kept.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("__first")
    agg = df.groupBy(*keys).agg(packed)
    return agg.select(*[F.col(c) if c in keys else F.col(f"__first.{c}").alias(c) for c in df.columns])


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """New names by position."""
    return df.toDF(*names)


def first_positions_ci(names: Sequence[str]) -> list[int]:
    """Positions of the names that no earlier name equals ignoring case."""
    upper = pd.Series([n.upper() for n in names], dtype=object)
    return upper.index[~upper.duplicated()].tolist()


def dedup_columns_ci(df: DataFrame, original_names: Sequence[str] | None = None) -> DataFrame:
    """Keep the first column of each case-insensitive name, then upper-case all names.

    ``original_names`` are the names as written when Spark had to rename clashing ones.
    """
    names = list(original_names or df.columns)
    keep = first_positions_ci(names)
    tmp = [f"__c{i}" for i in range(len(df.columns))]
    return df.toDF(*tmp).select(*[tmp[i] for i in keep]).toDF(*[names[i].upper() for i in keep])


def drop_if_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """P5: drop the listed columns that exist (exact names)."""
    present = [c for c in df.columns if c in set(names)]
    return df.drop(*present)


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns of ``left`` also in ``right``, in ``left``'s order."""
    rset = set(right.columns)
    return [c for c in left.columns if c in rset]


def split_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric columns, other columns), each in frame order."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    other = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]
    return num, other


def present_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The listed names that exist, in the listed order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def with_row_total(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """Row-wise sum over the present columns, missing values skipped.

    The total comes from a one-row generator, so that a filter on it stays above: pushed below, it would
    hold a copy of every summed column's expression, and planning time doubles with each of them.
    """
    return df.select("*", F.explode(F.array(row_total(present_columns(df, columns)))).alias(out))


def keep_positive(df: DataFrame, col: str) -> DataFrame:
    """F8: rows whose value is > 0 (NaN is not positive).

    One reference to the column: the filter may be pushed below the projection that computes it,
    and each reference then carries the whole expression.
    """
    return df.filter(F.nanvl(F.col(col), F.lit(0.0)) > 0)


def replace_from_clean(original: DataFrame, names: Sequence[str], column: str,
                       scorer: Callable[[DataFrame], DataFrame], value_col: str) -> DataFrame:
    """Every row of ``original`` with ``column`` replaced by what ``scorer`` adds as ``value_col``.

    The scorer is given the cleaned columns (P4: the first of each name, upper-cased) beside the
    original ones, which it passes through; no join, so repeated and null ids keep their rows.
    ``names`` are the headers as written. Columns keep their order and names.
    """
    kept = [f"__o{i}" for i in range(len(original.columns))]
    cleaned = original.toDF(*kept).select("*", *[F.col(kept[i]).alias(names[i].upper()) for i in first_positions_ci(names)])
    out = scorer(cleaned)
    return out.select(*[(F.col(value_col) if c == column else F.col(k)).alias(c) for k, c in zip(kept, original.columns)])


def wide_to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str, val: str) -> DataFrame:
    """Wide columns to (ids..., var, val) rows."""
    return df.unpivot(list(ids), list(values), var, val)


def long_to_wide(df: DataFrame, ids: Sequence[str], pivot: str, levels: Sequence, value: Column,
                 names: Sequence[str], fill: float | None = None) -> DataFrame:
    """(ids, pivot, value) rows to one column per level (conditional aggregation, one shuffle)."""
    aggs = []
    for lvl, name in zip(levels, names):
        e = F.sum(F.when(F.col(pivot) == F.lit(lvl), value))
        aggs.append((F.coalesce(e, F.lit(fill)) if fill is not None else e).alias(name))
    return df.groupBy(*ids).agg(*aggs)
