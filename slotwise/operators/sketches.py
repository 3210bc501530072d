"""Stored sketches per group and day that merge over any range of days.

The exact quantiles and distinct counts of `ranks` and `categories` read every row again for
each range; these read one small row per group and day. Quantiles come from KLL sketches, whose
rank is off by more than `rank_error` once in a hundred times, distinct counts from HLL
sketches with a relative standard error of `distinct_error`. Neither depends on how many days
are merged or how many rows they hold.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from slotwise.functions.times import day_number

ACCURACY = 800
REGISTERS = 12


def rank_error(accuracy: int = ACCURACY) -> float:
    """Largest distance between the wanted share of rows and that below a quantile, in 99 of 100 cases."""
    return 2.296 / accuracy**0.9723


def distinct_error(registers: int = REGISTERS) -> float:
    return 1.04 / math.sqrt(2**registers)


def daily_sketches(
    df: DataFrame,
    groups: list[str],
    ts: str,
    values: list[str],
    counted: list[str] = (),
    accuracy: int = ACCURACY,
    registers: int = REGISTERS,
) -> DataFrame:
    """One row per group and day: its rows, a quantile sketch for each of ``values`` and a
    distinct-count sketch for each of ``counted``. Sketches are made before the shuffle and
    merged after it, so a hot group is a few rows there. NULL and NaN are not in a sketch."""
    made = [
        F.kll_sketch_agg_double(F.nanvl(F.col(c).cast("double"), F.lit(None)), accuracy).alias(f"{c}_kll") for c in values
    ]
    made += [F.hll_sketch_agg(F.col(c).cast("string"), registers).alias(f"{c}_hll") for c in counted]
    day = day_number(F.col(ts)).alias("day_no")
    return df.groupBy(*groups, day).agg(F.count(F.lit(1)).alias("rows"), *made)


def merged(
    sketches: DataFrame,
    groups: list[str],
    first: int | None = None,
    last: int | None = None,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Sketches of the days ``first`` to ``last`` (day numbers, both included) put together."""
    rows = sketches
    if first is not None:
        rows = rows.where(F.col("day_no") >= first)
    if last is not None:
        rows = rows.where(F.col("day_no") <= last)
    out = [F.sum("rows").alias("rows")]
    out += [F.kll_merge_agg_double(c, accuracy).alias(c) for c in sketches.columns if c.endswith("_kll")]
    out += [F.hll_union_agg(c).alias(c) for c in sketches.columns if c.endswith("_hll")]
    return rows.groupBy(*groups).agg(*out)


def answers(merged_rows: DataFrame, wanted: dict[str, float]) -> DataFrame:
    """``<value>_n`` and ``<value>_<name>`` for each wanted quantile, ``<column>_distinct`` for
    each counted column, in place of the sketches. Quantiles of no values are NULL."""
    out = []
    for c in merged_rows.columns:
        base = c[:-4]
        if c.endswith("_kll"):
            n = F.kll_sketch_get_n_double(c)
            out.append(n.alias(f"{base}_n"))
            out += [
                F.when(n > 0, F.kll_sketch_get_quantile_double(c, F.lit(p))).alias(f"{base}_{name}")
                for name, p in wanted.items()
            ]
        elif c.endswith("_hll"):
            out.append(F.hll_sketch_estimate(c).alias(f"{base}_distinct"))
        else:
            out.append(F.col(c))
    return merged_rows.select(*out)
