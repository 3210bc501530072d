"""Calendar features."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

MICROS_PER_HOUR = 3_600_000_000

# Month -> season (fixed values).
SEASONS = {
    "winter": [12, 1, 2],
    "spring": [3, 4, 5],
    "summer": [6, 7, 8],
    "autumn": [9, 10, 11],
}


def hour_bucket(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def day_number(ts: Column) -> Column:
    """Days since 1970-01-01, the integer order key of the trailing windows."""
    return F.unix_date(ts.cast("date"))


def season(ts: Column) -> Column:
    month = F.month(ts)
    out = F.lit(None).cast("string")
    for name, months in SEASONS.items():
        out = F.when(month.isin(months), name).otherwise(out)
    return out


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * value / F.lit(period)
    return F.sin(angle), F.cos(angle)


def utc_text(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00"))


def duration_hours(start: Column, end: Column) -> Column:
    """Length of an interval in hours, never below zero."""
    hours = (F.unix_micros(end) - F.unix_micros(start)) / F.lit(MICROS_PER_HOUR)
    return F.greatest(F.lit(0.0), hours)
