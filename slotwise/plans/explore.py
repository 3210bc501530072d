"""Exploratory statistics over the feature table."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from slotwise.operators.categories import stacked
from slotwise.operators.ranks import picked_quantiles, quantile_from_counts, running_sums


def delay_rates(df: DataFrame, keys: dict[str, Column], late: Column, minutes: Column) -> DataFrame:
    """Late rate, mean delay and rows per group."""
    return df.groupBy(*[c.alias(name) for name, c in keys.items()]).agg(
        F.avg(late.cast("int")).alias("delay_rate"),
        F.avg(minutes).alias("avg_delay_min"),
        F.count(late).alias("rows"),
    )


def worst_groups(
    df: DataFrame, key: str, late: Column, minutes: Column, min_rows: int, k: int | None = 15
) -> DataFrame:
    """Groups with enough support, highest late rate first."""
    rates = delay_rates(df.where(F.col(key).isNotNull()), {key: F.col(key)}, late, minutes)
    ranked = rates.where(F.col("rows") >= min_rows).orderBy(F.desc("delay_rate"), F.asc(key))
    return ranked if k is None else ranked.limit(k)


def equal_width_rates(df: DataFrame, value: str, late: Column, bins: int = 8) -> DataFrame:
    """Late rate per equal-width bin, closed on the right; empty bins included.

    A column of one value gets a range of a thousandth of it to either side.
    """
    rows = df.where(F.col(value).isNotNull())
    span = rows.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    spread = F.when(lo == 0, F.lit(0.001)).otherwise(F.abs(lo) / 1000)
    lo, hi = F.when(lo < hi, lo).otherwise(lo - spread), F.when(lo < hi, hi).otherwise(hi + spread)
    width = (hi - lo) / bins
    number = F.greatest(F.ceil((F.col(value) - lo) / width), F.lit(1)).cast("int")
    counted = rows.groupBy(F.least(number, F.lit(bins)).alias("bin")).agg(
        F.avg(late.cast("int")).alias("delay_rate"), F.count(F.lit(1)).alias("rows")
    )
    all_bins = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counted, "bin", "left").select(
        "bin",
        (lo + (F.col("bin") - 1) * width).alias("low"),
        (lo + F.col("bin") * width).alias("high"),
        "delay_rate",
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def fixed_histogram(df: DataFrame, value: Column, low: float, high: float, bins: int) -> DataFrame:
    """Rows per equal-width bin of [low, high]; the last bin includes ``high``."""
    place = F.when(value == high, bins).otherwise(F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins)))
    inside = df.select(place.cast("int").alias("bin")).where(F.col("bin").between(1, bins))
    return inside.groupBy("bin").agg(F.count(F.lit(1)).alias("rows"))


def rates_up_to_quantile(df: DataFrame, value: str, late: Column, probability: float = 0.95) -> DataFrame:
    """Late rate per value, up to the given quantile of the distinct values."""
    rates = df.where(F.col(value).isNotNull()).groupBy(value).agg(
        F.avg(late.cast("int")).alias("delay_rate"), F.count(F.lit(1)).alias("rows")
    )
    cut = quantile_from_counts(rates.select(value, F.lit(1).alias("n")), [], value, probability)
    return rates.where(F.col(value) <= cut.select("quantile").scalar())


def rates_up_to(df: DataFrame, value: Column, name: str, late: Column, limit: int) -> DataFrame:
    return (
        df.where(value.isNotNull())
        .groupBy(value.alias(name))
        .agg(F.avg(late.cast("int")).alias("delay_rate"), F.count(F.lit(1)).alias("rows"))
        .where(F.col(name) <= limit)
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows and percentage per value, NULL included."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    total = df.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("pct", 100.0 * F.col("rows") / total)


def missing_profile(df: DataFrame, columns: list[str] | None = None, only_missing: bool = True) -> DataFrame:
    """Missing rows and percentage per column, from one aggregation."""
    columns = columns or df.columns
    nulls = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("missing")) for c in columns])
    out = nulls.select("_rows", F.explode(pairs).alias("_p")).select(
        "_p.feature", "_p.missing", F.round(100.0 * F.col("_p.missing") / F.col("_rows"), 2).alias("missing_pct")
    )
    return out.where("missing > 0") if only_missing else out


def crosstab(df: DataFrame, rows: Column, columns: Column, labels: list[str]) -> DataFrame:
    """Counts of a row category by known column categories, 0 where none."""
    cells = df.select(rows.alias("category"), columns.alias("_c"))
    return cells.groupBy("category").pivot("_c", labels).count().na.fill(0, labels)


def crosstab_with_margins(df: DataFrame, rows: Column, columns: Column) -> DataFrame:
    """Counts per pair with row, column and grand totals (label ``All``)."""
    cells = df.select(rows.cast("string").alias("a"), columns.cast("string").alias("b"))
    return (
        cells.where("a is not null and b is not null")
        .cube("a", "b")
        .agg(F.count(F.lit(1)).alias("rows"), F.grouping("a").alias("_ga"), F.grouping("b").alias("_gb"))
        .select(
            F.when(F.col("_ga") == 1, "All").otherwise(F.col("a")).alias("row_label"),
            F.when(F.col("_gb") == 1, "All").otherwise(F.col("b")).alias("column_label"),
            "rows",
        )
    )


def flag_effect(df: DataFrame, flags: list[str], late: Column) -> DataFrame:
    """Late percentage with the flag off and on, per flag."""
    shaped = df.select(late.cast("int").alias("_late"), *flags)
    rows = stacked(shaped, flags, ["_late"]).where("value is not null")
    on = F.col("value") == "true"
    return rows.groupBy("feature").agg(
        (100 * F.avg(F.when(~on, F.col("_late")))).alias("false_rate"),
        (100 * F.avg(F.when(on, F.col("_late")))).alias("true_rate"),
    )


def correlation_p_value(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation of ``n`` pairs (point-biserial or Pearson) under
    no correlation; NULL below three pairs.

    With r = sin(a) the density is cos(a)^(n - 3), so the p-value is the share of its
    integral beyond abs(r). Simpson's rule; beyond 12 standard deviations nothing is left.
    """
    power, steps = F.greatest(n - 3, F.lit(0)), 400
    end = F.least(F.lit(math.pi / 2), F.try_divide(F.lit(12.0), F.sqrt(power)))

    def integral(start: Column) -> Column:
        width = F.greatest(end - start, F.lit(0.0)) / steps
        weight = lambda i: F.when(i.isin(0, steps), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        add = lambda total, i: total + weight(i) * F.pow(F.cos(start + i * width), power)
        return F.aggregate(F.sequence(F.lit(0), F.lit(steps)), F.lit(0.0), add) * width / 3

    return F.when(n > 2, integral(F.asin(F.abs(r))) / integral(F.lit(0.0)))


def correlations(
    df: DataFrame, features: list[str], targets: dict[str, Column], min_rows: int = 20, p_values: list[str] = ()
) -> DataFrame:
    """Pearson correlation of every feature with every target over complete pairs, with a
    column ``<target>_p`` for the targets in ``p_values``; those must not be NULL."""
    aggregates = []
    for i, f in enumerate(features):
        x = F.col(f).cast("double")
        aggregates.append(F.count(x).alias(f"n{i}"))
        aggregates += [F.corr(x, t.cast("double")).alias(f"r{i}_{name}") for name, t in targets.items()]
    one = df.agg(*aggregates)
    rows = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                F.col(f"n{i}").alias("valid_rows"),
                *[F.col(f"r{i}_{name}").alias(name) for name in targets],
            )
            for i, f in enumerate(features)
        ]
    )
    found = one.select(F.explode(rows).alias("_r")).select("_r.*").where(F.col("valid_rows") >= min_rows)
    return found.withColumns(
        {f"{name}_p": correlation_p_value(F.col(name), F.col("valid_rows")) for name in p_values}
    )


def correlation_matrix(df: DataFrame, features: list[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations, one row per ordered pair a < b."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1 :]]
    one = df.agg(
        *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    )
    rows = F.array(
        *[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    )
    return one.select(F.explode(rows).alias("_r")).select("_r.*")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max and missing percentage per column."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    long = df.select(F.explode(pairs).alias("_p")).select("_p.feature", "_p.value")
    base = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        (100.0 * F.count_if(F.col("value").isNull()) / F.count(F.lit(1))).alias("missing_pct"),
    )
    counts = long.where("value is not null").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_sums(counts, ["feature"], "value", ["n"])
    quartiles = picked_quantiles(ranked, ["feature"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return base.join(quartiles, "feature", "left")


def table_profile(df: DataFrame, ts: str) -> DataFrame:
    """Rows, columns and time range."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
        F.min(ts).alias("time_min"),
        F.max(ts).alias("time_max"),
    )
