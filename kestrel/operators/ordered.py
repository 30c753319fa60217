"""Order-dependent operators that stay parallel when one group is huge, as DataFrame operations only.

``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one task, so a key holding a
third of the rows becomes a third of the job in a single task, and a window with no partition key
runs in one task outright. The operators here give the same results with the work split by range:

1. ``repartitionByRange`` on (keys, order) cuts a hot key into many ranges.
2. Windows inside (range, key) give each row's value as if the key began with the range. One sort serves
   them all. The rows are written to the shared scratch folder with these values and their range number, so
   that the next steps see the same ranges (range bounds come from sampling).
3. Ranges follow one another, so a key goes on into the next range only if it is the last of its own: the
   last row of each range holds all the state that is carried. These rows, one for each range whatever the
   number of keys, give the state that enters the next range.
4. The entering state is broadcast (one row for each range at most) and joined on (range, key): ``lag``
   takes it on a piece's first row, ``ffill`` where nothing was seen yet, ``cumsum`` adds it.

All columns of the frame are stored, for they are returned: select what is needed first.

Supported operations: ``lag`` (previous row's value in the group), ``ffill`` (last non-null value so
far in the group, current row included) and ``cumsum`` (running sum in the group, current row
included, nulls as 0). ``keys=[]`` treats the whole frame as one group (row numbers, prefix sums).
There is one path for every size. Values never leave their Spark types; the sum of doubles is added
up range by range, in another order than a single window's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from kestrel.session import written

_KINDS = ("lag", "ffill", "cumsum")


def ordered_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                 ops: Sequence[tuple[str, str, str]], n_partitions: int | None = None,
                 out_types: dict[str, T.DataType] | None = None) -> DataFrame:
    """Add one column per ``(kind, input_col, output_col)`` computed in (keys, order) order.

    ``order`` must make the order total inside each key (add a unique tiebreak column), otherwise
    the result depends on arrival order exactly as a window's would. Null keys form one group.
    """
    keys, ops = list(keys), [tuple(o) for o in ops]
    for kind, _, _ in ops:
        if kind not in _KINDS:
            raise ValueError(f"unknown ordered operation {kind!r}")
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    n = n_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *[F.col(k) for k in keys], *order_cols)
    ranged = ranged.withColumn("__range", F.spark_partition_id())

    piece = Window.partitionBy("__range", *keys).orderBy(*order_cols)
    so_far = piece.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("__range").orderBy(*[F.col(k) for k in keys], *order_cols)
    local = [F.lead(F.lit(True)).over(whole).isNull().alias("__last"), F.row_number().over(piece).alias("__at")]
    for j, (kind, src, _) in enumerate(ops):
        if kind == "lag":
            local.append(F.lag(src).over(piece).alias(f"__v{j}"))
        elif kind == "ffill":
            local.append(F.last(src, ignorenulls=True).over(so_far).alias(f"__v{j}"))
        else:
            local.append(F.sum(F.coalesce(F.col(src), F.lit(0))).over(so_far).alias(f"__v{j}"))
    staged = written(ranged.select("*", *local), "ordered")

    ends = staged.where("__last")  # one row for each range that has rows
    upto = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    entering = []
    for j, (kind, src, _) in enumerate(ops):
        if kind == "lag":
            e = F.struct(F.col(src).alias("s"))
        elif kind == "ffill":
            e = F.last(f"__v{j}", ignorenulls=True).over(upto)
        else:
            e = F.sum(f"__v{j}").over(upto)
        entering.append(e.alias(f"__e{j}"))
    after = F.lead("__range").over(Window.orderBy("__range")).alias("__r")
    carried = ends.select(after, *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *entering).where("__r is not null")

    same = F.col("__range") == F.col("__r")
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}"))
    joined = staged.join(F.broadcast(carried), same, "left")
    out = []
    for j, (kind, _, name) in enumerate(ops):
        v, e = F.col(f"__v{j}"), F.col(f"__e{j}")
        if kind == "lag":
            c = F.when(F.col("__at") == 1, e.getField("s")).otherwise(v)
        elif kind == "ffill":
            c = F.coalesce(v, e)
        else:
            c = F.when(e.isNull(), v).otherwise(v + e)
        t = (out_types or {}).get(name)
        out.append((c.cast(t) if t is not None else c).alias(name))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *out)


def lag_in_order(df: DataFrame, keys, order, col: str, out: str, **kw) -> DataFrame:
    """Previous row's ``col`` within each key in ``order`` (null on each key's first row)."""
    return ordered_scan(df, keys, order, [("lag", col, out)], **kw)


def fill_forward(df: DataFrame, keys, order, col: str, out: str, **kw) -> DataFrame:
    """Last non-null ``col`` so far within each key, current row included (null before the first)."""
    return ordered_scan(df, keys, order, [("ffill", col, out)], **kw)


def cumulative_sum(df: DataFrame, keys, order, col: str, out: str, **kw) -> DataFrame:
    """Running sum of ``col`` within each key, current row included (nulls count as 0)."""
    return ordered_scan(df, keys, order, [("cumsum", col, out)], **kw)


def row_number_in_order(df: DataFrame, keys, order, out: str = "row_number", **kw) -> DataFrame:
    """1-based position within each key by ``order``: ``row_number()`` without a single-task window."""
    tmp = "__kestrel_one"
    res = ordered_scan(df.withColumn(tmp, F.lit(1).cast("long")), keys, order, [("cumsum", tmp, out)], **kw)
    return res.drop(tmp)
