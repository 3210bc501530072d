"""Left join of a large table with a pre-aggregated one, safe for hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def same_key(keys: list[str], renamed: list[str], null_safe: bool) -> Column:
    """Equality of key pairs; ``null_safe`` makes NULL keys meet each other."""
    pairs = [
        F.col(k).eqNullSafe(F.col(r)) if null_safe else F.col(k) == F.col(r)
        for k, r in zip(keys, renamed)
    ]
    return reduce(lambda a, b: a & b, pairs)


def attach(
    fact: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    weight: str,
    spread_by: list[str],
    null_safe: bool = False,
    weights: DataFrame | None = None,
) -> DataFrame:
    """Add the columns of ``lookup`` (one row per key) to every row of ``fact``.

    ``weight`` is the lookup column that tells how many rows carry the key;
    ``weights`` (keys and weight) may be given where it is cheaper to read than
    ``lookup``. A key heavier than an average shuffle partition is split: its lookup
    row is copied once per slice and its fact rows choose a slice by a hash of
    ``spread_by``. At most ``spark.sql.shuffle.partitions`` keys can be that heavy,
    so the broadcast list of hot keys has a fixed bound. Without such a key this is
    a plain join. Whether the lookup itself is small enough to broadcast is left to
    Spark, which knows or measures its size.
    """
    weights = lookup if weights is None else weights
    right = [f"_r_{k}" for k in keys]
    renamed = [F.col(k).alias(r) for k, r in zip(keys, right)]
    added = [c for c in lookup.columns if c not in {*keys, weight}]
    match = same_key(keys, right, null_safe)

    load = weights.agg(F.sum(weight).alias("total"), F.max(weight).alias("top")).first()
    partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not load["total"] or load["top"] * partitions <= load["total"]:
        return fact.join(lookup.select(*renamed, *added), match, "left").select(
            *fact.columns, *added
        )

    share = F.col(weight) * F.lit(partitions) / F.lit(load["total"])
    slices = F.greatest(F.ceil(share), F.lit(1)).cast("int")
    hot = weights.where(share > 1).select(*renamed, slices.alias("_slices"))
    slice_count = F.coalesce("_slices", F.lit(1))
    if not null_safe:
        # Rows that cannot match anything are spread as well.
        unmatched = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        slice_count = F.when(unmatched, partitions).otherwise(slice_count)
    slice_of = F.pmod(F.xxhash64(*spread_by), slice_count).cast("int")
    sliced = fact.join(F.broadcast(hot), match, "left").select(
        *fact.columns, slice_of.alias("_slice")
    )
    spread = lookup.select(
        *renamed, *added, F.explode(F.sequence(F.lit(0), slices - 1)).alias("_r_slice")
    )
    return sliced.join(spread, match & (F.col("_slice") == F.col("_r_slice")), "left").select(
        *fact.columns, *added
    )
