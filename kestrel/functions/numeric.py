"""Numeric expressions: row totals, exact sums, half-up rounding that agrees across engines."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_as_zero(c: Column | str) -> Column:
    """null and NaN both count as 0.0 (a sum that skips missing values)."""
    return F.nanvl(F.coalesce(_c(c).cast("double"), F.lit(0.0)), F.lit(0.0))


def row_total(cols: Sequence[Column | str]) -> Column:
    """Row-wise sum over columns skipping null/NaN, added left to right starting from 0.0."""
    return reduce(lambda acc, c: acc + nan_as_zero(c), cols, F.lit(0.0))


def exact_sum(c: Column | str, scale: int = 2, precision: int = 18) -> Column:
    """Sum as a double; of values with at most ``scale`` decimals it is added up exactly in decimal.

    A double sum depends on the order rows arrive in; the decimal one does not, so every engine
    and every partitioning gives the same bits. A group with a value of more decimals, or too large,
    is summed as doubles: no value is cut.
    """
    c = _c(c)
    dec, value = c.try_cast(f"decimal({precision},{scale})"), c.cast("double")
    fits = F.bool_and(F.coalesce(dec.cast("double") == value, c.isNull()))
    return F.when(fits, F.sum(dec).cast("double")).otherwise(F.sum(value))


def exact_difference(a: Column | str, b: Column | str, scale: int = 2) -> Column:
    """a - b as a double: in decimal where both have at most ``scale`` decimals, else in doubles."""
    a, b = _c(a), _c(b)
    da, db = (x.try_cast(f"decimal(18,{scale})") for x in (a, b))
    fits = (da.cast("double") == a.cast("double")) & (db.cast("double") == b.cast("double"))
    return F.when(fits, (da - db).cast("double")).otherwise(a.cast("double") - b.cast("double"))


def round_half_up(c: Column | str, digits: int = 2) -> Column:
    """Round half away from zero through an 8-place decimal: stable across engines for doubles."""
    return F.round(_c(c).cast("decimal(20,8)"), digits).cast("double")


def celsius_to_fahrenheit(c: Column | str) -> Column:
    """x * 9 / 5 + 32 in double arithmetic."""
    return _c(c) * F.lit(9.0) / F.lit(5.0) + F.lit(32.0)
