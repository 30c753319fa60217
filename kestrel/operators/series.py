"""Time series: first row per group, hourly-to-daily roll-up, deltas to the previous row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from kestrel.functions.numeric import celsius_to_fahrenheit, exact_difference, exact_sum, round_half_up
from kestrel.functions.temporal import local_date
from kestrel.operators.ordered import lag_in_order


def first_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) = 1`` keeping ``columns``.

    A ``min(struct(order..., columns...))`` aggregate: each task sorts and reduces its own rows before
    the shuffle, so a hot key costs one row per task after it.
    """
    order, columns = list(order), list(columns)
    payload = order + [c for c in columns if c not in order]
    agg = df.groupBy(*keys).agg(F.min(F.struct(*payload)).alias("__first"))
    return agg.select(*keys, *[F.col(f"__first.{c}").alias(c) for c in columns])


def daily_rollup(df: DataFrame, place: str, ts: str, temp: str, tiebreak: str, first_of_day: str,
                 country: str | None = None, offset: str = "-05:00",
                 avg_cols: Mapping[str, str] | None = None, max_cols: Mapping[str, str] | None = None,
                 date_col: str = "fecha") -> DataFrame:
    """Hourly readings in degrees C to one row per (place[, country], local day).

    temperatura_f = round(avg(temp) * 9/5 + 32, 2); temp_max_f / temp_min_f likewise on max and
    min; ``avg_cols`` are rounded averages (nulls ignored) and ``max_cols`` plain maxima. Averages use
    exact decimal sums. ``first_of_day`` is the value of the first reading (by ts, then tiebreak) of the
    place's day: all country rows of a place and day share it. The numbers are a hash aggregate of
    their own.
    """
    place_day = [F.col(place), local_date(ts, offset).alias(date_col)]
    country_keys = [F.col(country)] if country else []
    t = F.col(temp)
    aggs = [
        round_half_up(celsius_to_fahrenheit(F.try_divide(exact_sum(t), F.count(t)))).alias("temperatura_f"),
        round_half_up(celsius_to_fahrenheit(F.max(t))).alias("temp_max_f"),
        round_half_up(celsius_to_fahrenheit(F.min(t))).alias("temp_min_f"),
    ]
    for out, c in (max_cols or {}).items():
        aggs.append(F.max(c).alias(out))
    for out, c in (avg_cols or {}).items():
        aggs.append(round_half_up(F.try_divide(exact_sum(c), F.count(c))).alias(out))
    numbers = df.groupBy(*place_day, *country_keys).agg(*aggs)
    first = df.groupBy(F.col(place).alias("__place"), place_day[1].alias("__day")).agg(
        F.min(F.struct(F.col(ts), F.col(tiebreak), F.col(first_of_day))).getField(first_of_day).alias(first_of_day))
    same = numbers[place].eqNullSafe(first["__place"]) & numbers[date_col].eqNullSafe(first["__day"])
    return numbers.join(first, same).drop("__place", "__day")


def delta_to_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, out: str,
                      scale: int = 2) -> DataFrame:
    """``col - LAG(col) OVER (PARTITION BY keys ORDER BY order)`` in exact decimals.

    The previous *row* of the key, whatever the gap. Null on each key's first row. Runs as an
    ordered scan, so a key holding most rows is still split over many tasks.
    """
    prev = "__prev"
    lagged = lag_in_order(df, keys, order, col, prev)
    return lagged.withColumn(out, exact_difference(col, prev, scale)).drop(prev)
