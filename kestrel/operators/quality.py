"""Declared constraints as data-quality checks: one report row per rule with its violation count.

All row-level rules of a table are counted in one aggregate (one scan, partial aggregation);
each uniqueness rule is one grouped count. The report is a small long frame:
(check_name, table_name, column_name, violations).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    kind: str                      # not_null | domain | non_negative | max_length | decimal_fit | unique
    columns: tuple[str, ...]
    values: tuple = field(default=())      # domain values
    allow_null: bool = False               # domain: nullable variant
    limit: int = 0                         # max_length
    precision: int = 0                     # decimal_fit
    scale: int = 0

    @property
    def name(self) -> str:
        return self.kind

    @property
    def column_label(self) -> str:
        return ",".join(self.columns)


def not_null(c: str) -> Rule:
    return Rule("not_null", (c,))


def domain(c: str, values: Sequence, allow_null: bool = False) -> Rule:
    return Rule("domain", (c,), tuple(values), allow_null)


def non_negative(c: str) -> Rule:
    return Rule("non_negative", (c,))


def max_length(c: str, n: int) -> Rule:
    return Rule("max_length", (c,), limit=n)


def decimal_fit(c: str, precision: int, scale: int) -> Rule:
    return Rule("decimal_fit", (c,), precision=precision, scale=scale)


def unique(*cols: str) -> Rule:
    return Rule("unique", tuple(cols))


def violation(rule: Rule) -> Column:
    """Row-level violation test (true = violates); not for ``unique``."""
    c = F.col(rule.columns[0])
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "domain":
        bad = ~c.isin(list(rule.values))
        return F.coalesce(bad, F.lit(not rule.allow_null))  # null: a violation unless allowed
    if rule.kind == "non_negative":
        return F.coalesce(c < 0, F.lit(False))
    if rule.kind == "max_length":
        return F.coalesce(F.length(c) > rule.limit, F.lit(False))
    if rule.kind == "decimal_fit":
        return c.isNotNull() & c.try_cast(f"decimal({rule.precision},{rule.scale})").isNull()
    raise ValueError(rule.kind)


def quality_report(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """Violations per rule. ``unique`` counts key values that occur more than once."""
    row_rules = [r for r in rules if r.kind != "unique"]
    parts = []
    if row_rules:
        counts = df.agg(*[F.count_if(violation(r)).alias(f"r{i}") for i, r in enumerate(row_rules)])
        entries = F.array(*[F.struct(F.lit(r.name).alias("check_name"), F.lit(table).alias("table_name"),
                                     F.lit(r.column_label).alias("column_name"),
                                     F.col(f"r{i}").cast("long").alias("violations"))
                            for i, r in enumerate(row_rules)])
        parts.append(counts.select(F.explode(entries).alias("e")).select("e.*"))
    for r in rules:
        if r.kind == "unique":
            dup = (df.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
                   .agg(F.count(F.lit(1)).cast("long").alias("violations")))
            parts.append(dup.select(F.lit(r.name).alias("check_name"), F.lit(table).alias("table_name"),
                                    F.lit(r.column_label).alias("column_name"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def violating_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows breaking any row-level rule, with the names of the rules they break."""
    row_rules = [r for r in rules if r.kind != "unique"]
    broken = F.filter(F.array(*[F.when(violation(r), F.lit(f"{r.name}:{r.column_label}")) for r in row_rules]),
                      lambda x: x.isNotNull())
    return df.withColumn("broken_rules", broken).filter(F.size("broken_rules") > 0)


def violations(df: DataFrame, table: str, rules: Sequence[Rule], keys: Sequence[str]) -> DataFrame:
    """One row per violation: (check_name, table_name, column_name, the ``keys`` of the row).

    The row-level rules take one pass. A row breaks a uniqueness rule when another has the same values, two
    nulls being the same: repeated values are counted first, combined in each task, and joined back, so that no
    window holds the rows of one value. Spark splits a value with many rows over tasks in that join.
    """
    row_rules = [r for r in rules if r.kind != "unique"]
    label = lambda r: F.struct(F.lit(r.name).alias("check_name"), F.lit(table).alias("table_name"),
                               F.lit(r.column_label).alias("column_name"))
    columns = ["check_name", "table_name", "column_name", *keys]
    parts = []
    if row_rules:
        broken = F.filter(F.array(*[F.when(violation(r), label(r)) for r in row_rules]), lambda x: x.isNotNull())
        parts.append(df.select(*keys, F.explode(broken).alias("__broken")).select("__broken.*", *keys))
    for r in rules:
        if r.kind == "unique":
            again = (df.groupBy(*[F.col(c).alias(f"__{c}") for c in r.columns]).agg(F.count(F.lit(1)).alias("__n"))
                     .where("__n > 1"))
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in r.columns])
            parts.append(df.join(again, same, "left_semi").select(label(r).alias("__broken"), *keys).select("__broken.*", *keys))
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])


def row_counts(tables: Mapping[str, DataFrame], label: str = "tabla", count_col: str = "filas") -> DataFrame:
    """One (label, count) row per table, unioned and ordered by label."""
    parts = [df.agg(F.count(F.lit(1)).alias(count_col)).select(F.lit(name).alias(label), count_col)
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(label)
