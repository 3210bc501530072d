"""Which validity intervals hold at a point in time, without pairing all rows.

An interval is clipped to the times that are asked for and cut into aligned blocks of
five lengths, from 64 seconds up. Runs of blocks are summed before they are spelled out, and
blocks before they meet the 64-second blocks that hold points. In the two of these in which an
interval begins and ends it counts for the points after its begin or before its end: running
sums over begins, points and ends in their order. Only intervals that begin and end in one such
block are compared with its points, and by an equal time if they hold a single one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotwise.session import persist_table

# Blocks of 64 s times 2**0, 2**4, 2**8, 2**12 and 2**16 (64 s, 17 min, 4.5 h, 3 days, 48 days).
TIERS = [0, 4, 8, 12, 16]
STEP = 4
UNIT = 64_000_000


def _unit(micros: Column) -> Column:
    """Smallest block that holds a time in microseconds."""
    return ((micros - F.pmod(micros, F.lit(UNIT).cast("long"))) / F.lit(UNIT)).cast("long")


def _span(start: Column, stop: Column, tier: int) -> Column:
    """The blocks [start, stop) of one tier, NULL when there are none."""
    return F.when(
        start < stop,
        F.struct(F.lit(tier).alias("tier"), start.alias("start"), (stop - 1).alias("last")),
    )


def _spans(df: DataFrame, low: str, high: str) -> DataFrame:
    """One row per run of equal blocks (tier, first, last) of the exact cover of the smallest
    blocks [low, high).

    Each tier takes what does not fill a block of the next one at either end. The
    bounds are columns of their own, so the expressions stay small.
    """
    out = df.withColumnsRenamed({low: "_lo0", high: "_hi0"})
    pieces = []
    for i, tier in enumerate(TIERS):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        if i + 1 == len(TIERS):
            pieces.append(_span(lo, hi, tier))
            break
        # Bounds in blocks of the next tier; nothing is left when no whole one fits.
        next_lo = F.shiftright(lo + (1 << STEP) - 1, STEP)
        out = out.withColumn(f"_lo{i + 1}", next_lo)
        up = F.col(f"_lo{i + 1}")
        out = out.withColumn(f"_hi{i + 1}", F.greatest(F.shiftright(hi, STEP), up))
        down = F.col(f"_hi{i + 1}")
        wide = up < down
        pieces += [
            _span(lo, F.when(wide, F.shiftleft(up, STEP)).otherwise(hi), tier),
            _span(F.when(wide, F.shiftleft(down, STEP)).otherwise(hi), hi, tier),
        ]
    bounds = [c for c in out.columns if c.startswith(("_lo", "_hi"))]
    spans = out.withColumn("_span", F.explode(F.array_compact(F.array(*pieces)))).drop(*bounds)
    return spans.select(
        "*", F.col("_span.tier").alias("tier"), F.col("_span.start").alias("_from"), F.col("_span.last").alias("_to")
    ).drop("_span")


def stab(
    points: DataFrame,
    intervals: DataFrame,
    place: str,
    at: str,
    start: str,
    end: str,
    sums: list[str],
    maxima: list[str],
    carry: list[str] = (),
) -> DataFrame:
    """For every distinct (place, at) that some closed interval [start, end] holds:
    the sums and maxima over those intervals, and the columns ``carry`` of its point.

    ``at``, ``start`` and ``end`` are long microseconds. ``points`` should be
    distinct already, and cheap to read: a first pass takes their earliest and latest
    time. Points inside no interval are absent from the result.

    Intervals end where the points end, so one that never ends makes no more blocks
    than the asked range holds.
    """
    # Intervals are counted, so that a point in none of them is known.
    sums, asked_for = ["_held", *sums], [*sums, *maxima]
    merge = [F.sum(c).alias(c) for c in sums] + [F.max(c).alias(c) for c in maxima]
    measures = [*sums, *maxima]
    earliest, latest = (F.lit(t).cast("long") for t in points.agg(F.min(at), F.max(at)).first())
    asked = intervals.where((F.col(start) <= F.col(end)) & (F.col(start) <= latest) & (F.col(end) >= earliest))
    clipped = asked.withColumns(
        {start: F.greatest(start, earliest), end: F.least(end, latest), "_held": F.lit(1).cast("long")}
    )
    distinct = clipped.groupBy(place, start, end).agg(*merge)
    # Each interval becomes many blocks, so the few intervals go to all tasks; they are read four times.
    tasks = int(intervals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = persist_table(distinct.repartition(tasks, end, start, place), "intervals")

    # Smallest blocks [low, high) wholly inside the interval, and the blocks of its two ends.
    cut = distinct.withColumns(
        {
            "_low": _unit(F.col(start) + UNIT - 1),
            "_first": _unit(F.col(start)),
            "_last": _unit(F.col(end)),
            "_high": _unit(F.col(end) + 1),
        }
    ).withColumn("_high", F.greatest("_low", "_high"))
    # Runs that begin or end alike are many intervals' own, and there are no more than blocks.
    covered = (
        _spans(cut.select(place, *measures, "_low", "_high"), "_low", "_high")
        .groupBy(place, "tier", "_from", "_to")
        .agg(*merge)
        .select(place, "tier", F.explode(F.sequence("_from", "_to")).alias("block"), *measures)
        .groupBy(place, "tier", "block")
        .agg(*merge)
    )
    looking = points.select(place, at, _unit(F.col(at)).alias("_s"), *carry)
    tiers = F.array(
        *[F.struct(F.lit(t).alias("tier"), F.shiftright("_s", t).alias("block")) for t in TIERS]
    )
    whole = (
        looking.select(place, "_s").distinct()
        .select(place, "_s", F.explode(tiers).alias("_b"))
        .select(place, "_s", F.col("_b.tier").alias("tier"), F.col("_b.block").alias("block"))
        .join(covered, [place, "tier", "block"])
        .groupBy(place, "_s")
        .agg(*[m.alias(f"_w_{c}") for m, c in zip(merge, measures)])
    )

    begins_cut, ends_cut = F.col("_first") < F.col("_low"), F.col("_last") >= F.col("_high")
    longer = F.col("_first") < F.col("_last")
    short = cut.where(~longer & (begins_cut | ends_cut)).select(place, start, end, *measures, F.col("_first").alias("_s"))
    moments = short.where(F.col(start) == F.col(end)).select(place, F.col(start).alias(at), *measures)
    inside = (
        looking.join(short.where(F.col(start) < F.col(end)), [place, "_s"])
        .where((F.col(start) <= F.col(at)) & (F.col(at) <= F.col(end)))
        .select(place, at, *measures)
        .unionByName(looking.join(moments, [place, at]).select(place, at, *measures))
        .groupBy(place, at)
        .agg(*merge)
    )

    def turns(rows: DataFrame, block: Column, time: str, order: int) -> DataFrame:
        """Begins (0), points (1) and ends (2) of intervals with their measures, a point with
        those of the intervals inside its block."""
        columns = [(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()]
        return rows.select(place, block.alias("_s"), F.col(time).alias(at), F.lit(order).alias("_turn"), *columns)

    kinds = {c: t for df, names in ((cut, measures), (points, carry)) for c, t in df.dtypes if c in names}
    line = reduce(
        DataFrame.unionByName,
        [
            turns(looking, F.col("_s"), at, 1),
            turns(inside, _unit(F.col(at)), at, 1),
            turns(cut.where(longer & begins_cut), F.col("_first"), start, 0),
            turns(cut.where(longer & ends_cut), F.col("_last"), end, 2),
        ],
    )
    # The block comes first: most rows are told apart by it when they are sorted.
    rows = Window.partitionBy("_s", place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    since, until = rows.orderBy(at, "_turn"), rows.orderBy(F.desc(at), F.desc("_turn"))
    running = {
        f"{p}{c}": (F.sum if c in sums else F.max)(F.when(F.col("_turn") == turn, F.col(c))).over(w)
        for p, w, turn in (("_o_", since, 0), ("_c_", until, 2)) for c in measures
    }
    found = line.withColumns(running).where("_turn = 1").groupBy("_s", place, at).agg(
        *[F.max(f"{p}{c}").alias(f"{p}{c}") for p in ("_o_", "_c_") for c in measures],
        *[F.max(c).alias(f"_i_{c}") for c in measures], *[F.max(c).alias(c) for c in carry],
    )
    found = found.join(whole, [place, "_s"], "left")

    def together(c: str) -> Column:
        parts = [F.col(f"{p}{c}") for p in ("_o_", "_c_", "_i_", "_w_")]
        if c in maxima:
            return F.greatest(*parts)
        # A sum of only NULL is NULL.
        total = reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(0)) for x in parts])
        return F.when(F.coalesce(*parts).isNotNull(), total)

    return found.where(together("_held") > 0).select(place, at, *[together(c).alias(c) for c in asked_for], *carry)
