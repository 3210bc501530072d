"""Ranks over a whole table without sorting it in one task.

Everything here starts from counts per distinct value. Those are written once in
ranges of (groups, value), summed inside each range, and shifted by the totals of
the ranges before it in the group, so no window spans more than one range of values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotwise.session import persist_table


def value_counts(df: DataFrame, groups: list[str], value: str, **sums: Column) -> DataFrame:
    """One row per (groups, value) with its row count ``n`` and further sums."""
    return df.groupBy(*groups, value).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(name) for name, c in sums.items()]
    )


def running_sums(
    counts: DataFrame, groups: list[str], value: str, measures: list[str]
) -> DataFrame:
    """Add ``cum_<m>`` and ``total_<m>``: inclusive sums in ascending value order.

    ``counts`` has one row per (groups, value), NULL first. ``total_<m>`` is the group
    total. There are as many ranges as shuffle partitions, for any number of groups; a
    group has one offset row per range it lies in, so those rows number at most groups
    plus ranges. The written table fixes which range a row is in.
    """
    ranged = counts.repartitionByRange(*groups, value).withColumn("_range", F.spark_partition_id())
    ranged = persist_table(ranged, "ranked-counts")
    whole = Window.partitionBy(*groups)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*groups, "_range").agg(*[F.sum(m).alias(m) for m in measures])
    offsets = sums.select(
        *[F.col(g).alias(f"_r_{g}") for g in groups],
        F.col("_range").alias("_r_range"),
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_offset_{m}") for m in measures],
        *[F.sum(m).over(whole).alias(f"total_{m}") for m in measures],
    )
    inside = Window.partitionBy(*groups, "_range").orderBy(value).rowsBetween(
        Window.unboundedPreceding, 0
    )
    summed = ranged.select("*", *[F.sum(m).over(inside).alias(f"_inside_{m}") for m in measures])
    same = F.col("_range") == F.col("_r_range")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_r_{g}"))
    return summed.join(offsets, same).select(
        *counts.columns,
        *[(F.col(f"_inside_{m}") + F.col(f"_offset_{m}")).alias(f"cum_{m}") for m in measures],
        *[f"total_{m}" for m in measures],
    )


def quantile_parts(
    value: str, wanted: dict[str, float], n: str = "n"
) -> tuple[list[Column], list[Column]]:
    """Aggregates over running sums, and the expressions that turn them into exact,
    linearly interpolated quantiles (name -> probability)."""
    first, last = F.col(f"cum_{n}") - F.col(n), F.col(f"cum_{n}") - 1
    v = F.col(value).cast("double")

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col(n) > 0) & (first <= rank) & (rank <= last), v))

    parts, out = [], []
    for name, probability in wanted.items():
        position = F.lit(probability) * (F.col(f"total_{n}") - 1)
        low, high, part = f"_low_{name}", f"_high_{name}", f"_part_{name}"
        parts += [
            at(F.floor(position)).alias(low),
            at(F.ceil(position)).alias(high),
            F.max(position - F.floor(position)).alias(part),
        ]
        out.append((F.col(low) + (F.col(high) - F.col(low)) * F.col(part)).alias(name))
    return parts, out


def picked_quantiles(
    ranked: DataFrame, groups: list[str], value: str, wanted: dict[str, float]
) -> DataFrame:
    parts, out = quantile_parts(value, wanted)
    return ranked.groupBy(*groups).agg(*parts).select(*groups, *out)


def quantile_from_counts(
    counts: DataFrame, groups: list[str], value: str, probability: float
) -> DataFrame:
    """Exact quantile per group from counts per value: column ``quantile``."""
    ranked = running_sums(counts.where(F.col(value).isNotNull()), groups, value, ["n"])
    return picked_quantiles(ranked, groups, value, {"quantile": probability})


def quantile(df: DataFrame, groups: list[str], value: str, probability: float) -> DataFrame:
    return quantile_from_counts(
        value_counts(df.where(F.col(value).isNotNull()), groups, value), groups, value, probability
    )


def median(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    return quantile(df, groups, value, 0.5).withColumnRenamed("quantile", "median")


def nth_keys(df: DataFrame, order: str, tie: str, positions: list[int]) -> list[tuple]:
    """The (order, tie) pairs at the given 0-based positions of the sorted table.

    ``order`` and ``tie`` are long columns, together unique. The order values of all
    positions are found from counts per value, then all ties among the rows that have them.
    """
    ranked = running_sums(value_counts(df, [], order), [], order, ["n"])
    wanted = F.array(*[F.lit(int(p)).cast("long") for p in positions])
    hits = ranked.select(
        order, (F.col("cum_n") - F.col("n")).alias("first"), "cum_n", F.explode(wanted).alias("p")
    ).where("p >= first and p < cum_n")
    found = {r["p"]: (r[order], r["p"] - r["first"]) for r in hits.collect()}
    missing = [p for p in positions if p not in found]
    if missing:
        raise ValueError(f"positions outside the table: {missing}")
    same = df.where(F.col(order).isin(sorted({at for at, _ in found.values()})))
    inner = running_sums(value_counts(same, [order], tie), [order], tie, ["n"])
    asked = F.lit(False)
    for at, rank in set(found.values()):
        here = (F.col("cum_n") > rank) & (F.col("cum_n") - F.col("n") <= rank)
        asked = asked | ((F.col(order) == at) & here)
    rows = inner.where(asked).select(order, tie, "cum_n", "n").collect()
    ties = {(r[order], i): r[tie] for r in rows for i in range(r["cum_n"] - r["n"], r["cum_n"])}
    return [(found[p][0], ties[found[p]]) for p in positions]


def before_key(order: Column, tie: Column, key: tuple) -> Column:
    """True for rows that sort strictly before ``key``."""
    at, tie_value = F.lit(key[0]), F.lit(key[1])
    return (order < at) | ((order == at) & (tie < tie_value))


def dense_index(df: DataFrame, order_hash: str, name: str) -> DataFrame:
    """Number the rows 0..n-1 in the order of a well-spread 64-bit hash column.

    Buckets are hash ranges, so they are even whatever the data looks like.
    """
    buckets = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    unsigned = F.col(order_hash) / F.lit(float(2**64)) + F.lit(0.5)
    cut = df.withColumn("_bucket", F.least(F.floor(unsigned * buckets), F.lit(buckets - 1)))
    offsets = (
        cut.groupBy("_bucket")
        .count()
        .select(
            "_bucket",
            F.coalesce(
                F.sum("count").over(
                    Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("_offset"),
        )
    )
    inside = Window.partitionBy("_bucket").orderBy(order_hash)
    return (
        cut.withColumn("_row", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col("_row") + F.col("_offset"))
        .drop("_bucket", "_row", "_offset")
    )
