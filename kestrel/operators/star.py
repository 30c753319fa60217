"""Star-schema joins: consolidation by dimension attributes, update-from-patch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kestrel.session import written


def consolidate(fact: DataFrame, dims: Sequence[tuple[DataFrame, str | Sequence[str] | Column]],
                group_by: Sequence[str | Column], aggregates: Sequence[Column]) -> DataFrame:
    """Inner-join the fact with each dimension in turn, then aggregate.

    Join strategy is left to the optimizer: dimensions whose size is known to be small are
    broadcast by ``spark.sql.autoBroadcastJoinThreshold`` (a size check on plan statistics), and AQE
    turns sort-merge joins into broadcast joins when the shuffled side is small at runtime. Large
    dimensions stay shuffle joins. Groups are by attribute values, not ids: two ids with equal
    attributes merge, as in the query this rebuilds.
    """
    out = fact
    for dim, on in dims:
        out = out.join(dim, on=on, how="inner")
    return out.groupBy(*group_by).agg(*aggregates)


@dataclass(frozen=True)
class Names:
    """A dimension that gives names for an id of the fact: its rows, its key, the fact's column, its named columns."""

    rows: DataFrame
    key: str
    fact_key: str
    names: Mapping[str, str]


def consolidate_by_ids(fact: DataFrame, dims: Sequence[Names], group_by: Mapping[str, str],
                       aggregates: Sequence[Column]) -> DataFrame:
    """``consolidate`` with the names joined to the sums instead of to the fact.

    Ids with equal names are one group, so each dimension first gives every id the smallest one of the same
    names (nulls are equal names). The fact is summed by these ids, which are narrow and reduce in each task,
    and what is left meets the names once: fact rows carry no text and are shuffled once for the groups.
    ``group_by`` are columns of the fact to group by as they are, under their new names.
    """
    def stage(i: int) -> DataFrame:
        d = dims[i]
        named = d.rows.select(F.col(d.key).alias(f"__id{i}"), *[F.col(c).alias(name) for name, c in d.names.items()])
        one = named.groupBy(*[F.col(c).alias(f"__{c}") for c in d.names]).agg(F.min(f"__id{i}").alias(f"__one{i}"))
        equal = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in d.names])
        return written(named.join(one, equal).select(f"__id{i}", f"__one{i}", *d.names), "names")

    with ThreadPoolExecutor(max(1, len(dims))) as pool:  # the dimensions do not wait for one another
        staged = list(pool.map(stage, range(len(dims))))
    out, keys = fact, [F.col(c).alias(name) for name, c in group_by.items()]
    for i, (d, ids) in enumerate(zip(dims, staged)):
        out = out.join(ids.select(f"__id{i}", f"__one{i}"), F.col(d.fact_key) == F.col(f"__id{i}"))
        keys.append(F.col(f"__one{i}"))
    summed = out.groupBy(*keys).agg(*aggregates)
    for i, (d, ids) in enumerate(zip(dims, staged)):
        names = ids.where(F.col(f"__id{i}") == F.col(f"__one{i}")).select(F.col(f"__id{i}").alias(f"__one{i}"), *d.names)
        summed = summed.join(names, f"__one{i}").drop(f"__one{i}")
    return summed


def update_from(base: DataFrame, patch: DataFrame, key: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``UPDATE base SET c = patch.c FROM patch WHERE key matches``.

    Left join on the key; matched rows take the patch value (null included), unmatched keep theirs.
    A key that the patch repeats takes its smallest row of new values, so base rows never multiply.
    """
    keys = [key] if isinstance(key, str) else list(key)
    one = F.min(F.struct(*[F.col(c) for c in columns])).alias("__new")
    p = patch.groupBy(*keys).agg(one).select(*keys, *[F.col(f"__new.{c}").alias(f"__new_{c}") for c in columns], F.lit(True).alias("__matched"))
    joined = base.join(p, on=keys, how="left")
    out = []
    for c in base.columns:
        if c in columns:
            out.append(F.when(F.col("__matched"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)
