"""Trailing delay statistics that never see their own day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from slotwise.functions.times import day_number
from slotwise.schemas import DELAY_THRESHOLD_MINUTES

TOTALS = ["n", "labelled", "minutes", "late"]


def key_day_totals(flights: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Delay sums per key and calendar day; unlabelled flights only count as rows."""
    d = F.col(delay)
    return flights.groupBy(*keys, day_number(F.col(ts)).alias("day_no")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(d).alias("labelled"),
        F.sum(d.cast("long")).alias("minutes"),
        F.count_if(d > DELAY_THRESHOLD_MINUTES).alias("late"),
    )


def rolled_up(totals: DataFrame, keys: list[str]) -> DataFrame:
    """Totals of finer keys summed to fewer keys."""
    sums = [F.sum(c).alias(c) for c in TOTALS]
    return totals.groupBy(*keys, "day_no").agg(*sums)


def trailing_stats(
    flights: DataFrame,
    keys: list[str],
    ts: str,
    delay: str,
    prefix: str,
    windows: tuple[int, ...] = (7, 30),
    keep_null_keys: bool = False,
) -> DataFrame:
    """One row per key and day: mean delay and late rate of the days before it.

    Rows are summed per day before the shuffle, so a window partition holds at
    most one row per calendar day however many flights the key has. ``n`` is the
    number of flights of the key on that day.
    """
    if not keep_null_keys:
        flights = flights.dropna(subset=keys)
    return from_totals(key_day_totals(flights, keys, ts, delay), keys, prefix, windows)


def from_totals(
    totals: DataFrame, keys: list[str], prefix: str, windows: tuple[int, ...] = (7, 30)
) -> DataFrame:
    """The windows over ready totals per key and day."""
    order = Window.partitionBy(*keys).orderBy("day_no")
    out = [*keys, "day_no", "n"]
    for days in windows:
        past = order.rangeBetween(-days, -1)
        count = F.sum("labelled").over(past)
        out.append(F.try_divide(F.sum("minutes").over(past), count).alias(f"{prefix}_avg_delay_{days}d"))
        out.append(F.try_divide(F.sum("late").over(past), count).alias(f"{prefix}_delay_rate_{days}d"))
    return totals.select(*out)
