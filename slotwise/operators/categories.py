"""Counts per category value, for many columns in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotwise.operators.attach import attach

OTHER = "OTHER"


def stacked(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """One row per (row, column): ``feature`` and its text ``value``."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.feature", "_p.value")


def category_counts(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Rows per (feature, value), NULL included. Counted before the shuffle."""
    return stacked(df, columns, keep).groupBy(*keep, "feature", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def group_rare(
    df: DataFrame, min_counts: dict[str, int], counts: DataFrame, spread_by: list[str]
) -> DataFrame:
    """Add ``<column>_grp``: values seen fewer than the minimum become ``OTHER``.

    ``counts`` are category counts (feature, value, n). A frequent NULL stays NULL.
    """
    out = df
    for column, minimum in min_counts.items():
        frequent = counts.where((F.col("feature") == column) & (F.col("n") >= minimum)).select(
            F.col("value").alias(column), "n", F.lit(True).alias("_kept")
        )
        out = attach(out, frequent, [column], "n", spread_by, null_safe=True)
        out = out.withColumn(
            f"{column}_grp", F.when(F.col("_kept"), F.col(column)).otherwise(F.lit(OTHER))
        ).drop("_kept")
    return out


def grouped_profile(counts: DataFrame, min_counts: dict[str, int]) -> list[dict]:
    """Column profile of the ``_grp`` columns, read off the category counts."""
    minimum = F.lit(0)
    for column, least in min_counts.items():
        minimum = F.when(F.col("feature") == column, least).otherwise(minimum)
    kept = F.when(F.col("n") >= minimum, F.col("value")).otherwise(F.lit(OTHER))
    groups = counts.groupBy("feature", kept.alias("value")).agg(F.sum("n").alias("n"))
    known = F.col("value").isNotNull()
    facts = groups.groupBy("feature").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("missing"),
        F.count(F.lit(1)).alias("groups"),
        F.max("n").alias("top"),
    )
    return [
        {
            "feature": f"{r['feature']}_grp",
            "rows": r["rows"],
            "missing": r["missing"],
            "constant": r["groups"] <= 1,
            "top_share": r["top"] / r["rows"],
        }
        for r in facts.where(F.col("feature").isin(list(min_counts))).collect()
    ]


def cardinality(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values (NULL counts as one), missing share, most frequent value."""
    counts = category_counts(df, columns)
    known = F.col("value").isNotNull()
    # min_by on (-n, value): among equally frequent values the smallest one.
    top = F.min(F.when(known, F.struct((-F.col("n")).alias("n"), "value")))
    return (
        counts.groupBy("feature")
        .agg(
            F.count(F.lit(1)).alias("n_unique"),
            F.sum("n").alias("rows"),
            F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("missing"),
            top.alias("_top"),
        )
        .select(
            "feature",
            "n_unique",
            F.round(100.0 * F.col("missing") / F.col("rows"), 2).alias("missing_pct"),
            F.col("_top.value").alias("top_value"),
            F.round(F.try_divide(-100.0 * F.col("_top.n"), F.col("rows") - F.col("missing")), 2).alias(
                "top_value_pct"
            ),
        )
    )


def most_frequent(counts: DataFrame) -> DataFrame:
    """Per feature the most frequent non-NULL value, the smallest one on a tie."""
    top = F.min(F.struct((-F.col("n")).alias("n"), "value"))
    return counts.where("value is not null").groupBy("feature").agg(top.alias("_t")).select(
        "feature", F.col("_t.value").alias("value"), (-F.col("_t.n")).alias("n")
    )
