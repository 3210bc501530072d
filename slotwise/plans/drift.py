"""How the test period differs from the training period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from slotwise.operators.categories import category_counts
from slotwise.operators.ranks import median, quantile_parts, running_sums


# Sides up to this many rows get the exact p-value; its work grows with rows times other rows squared.
EXACT_ROWS = 100


def _long(df: DataFrame, columns: list[str], split: str) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return (
        df.select(split, F.explode(pairs).alias("_p"))
        .select(split, "_p.feature", "_p.value")
        .where("value is not null")
    )


def numeric_drift(df: DataFrame, columns: list[str], split: str, train: str, test: str) -> DataFrame:
    """Means, medians and the two-sample Kolmogorov-Smirnov test per feature.

    Both distribution functions come from one running sum over the counts of the
    distinct values. Features without values on either side drop out.
    """
    is_train, is_test = F.col(split) == train, F.col(split) == test
    counts = _long(df, columns, split).groupBy("feature", "value").agg(
        F.count_if(is_train).alias("train"), F.count_if(is_test).alias("test")
    )
    ranked = running_sums(counts, ["feature"], "value", ["train", "test"])
    gap = F.abs(
        F.try_divide(F.col("cum_train"), F.col("total_train"))
        - F.try_divide(F.col("cum_test"), F.col("total_test"))
    )
    sides = [quantile_parts("value", {f"{s}_median": 0.5}, s) for s in ("train", "test")]
    stats = ranked.groupBy("feature").agg(
        F.try_divide(F.sum(F.col("value") * F.col("train")), F.sum("train")).alias("train_mean"),
        F.try_divide(F.sum(F.col("value") * F.col("test")), F.sum("test")).alias("test_mean"),
        F.max(gap).alias("ks_stat"),
        F.sum("train").alias("train_rows"),
        F.sum("test").alias("test_rows"),
        *[part for parts, _ in sides for part in parts],
    )
    return stats.where("train_rows > 0 and test_rows > 0").select(
        "feature", "train_mean", "test_mean",
        (F.col("test_mean") - F.col("train_mean")).alias("mean_diff"),
        *[c for _, out in sides for c in out],
        "ks_stat",
        ks_p_value(F.col("ks_stat"), F.col("train_rows"), F.col("test_rows")).alias("ks_p_value"),
        "train_rows", "test_rows",
    )


def ks_p_value(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value of a two-sample statistic: the alternating series of
    Kolmogorov's distribution, 1 where it has not converged because the statistic is tiny."""
    root = F.sqrt(n * m / (n + m).cast("double")) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda total, k: total
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * root * root),
    )
    return F.when(root < 0.05, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))


def exact_ks_p_value(statistic: Column, n: Column, m: Column) -> Column:
    """Exact two-sided p-value of a two-sample statistic, for samples without ties.

    Every order of n and m values is a path over a lattice of n by m, equally likely without a
    difference, and its statistic is the largest distance from the diagonal. So the paths
    that stay nearer than the statistic are counted line by line: a point is reached from
    the points before it in its line that are near enough, and those of the line before.
    """
    n, m = n.cast("long"), m.cast("long")
    bound = F.round(statistic * n * m).cast("long")

    def near(i: Column, j: Column) -> Column:
        return F.abs(i * m - j * n) < bound

    line = F.sequence(F.lit(0).cast("long"), m)
    first = F.transform(line, lambda j: F.when(near(F.lit(0).cast("long"), j), 1.0).otherwise(0.0))

    def after(before: Column, i: Column) -> Column:
        start = F.greatest(F.lit(0).cast("long"), F.floor((i * m - bound) / n) + 1)
        ways = lambda j: F.aggregate(F.slice(before, (start + 1).cast("int"), (j - start + 1).cast("int")), F.lit(0.0), lambda a, x: a + x)
        return F.transform(line, lambda j: F.when(near(i, j), ways(j)).otherwise(0.0))

    ways = F.element_at(F.aggregate(F.sequence(F.lit(1).cast("long"), n), first, after), -1)
    every = F.aggregate(F.sequence(F.lit(1).cast("long"), n), F.lit(1.0), lambda a, i: a * (m + i) / i)
    return F.greatest(F.lit(0.0), 1 - ways / every)


def ks_by_group(
    df: DataFrame, groups: list[str], value: str, split: str, train: str, test: str, exact_rows: int = EXACT_ROWS
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test of ``value`` per group: ks_stat, ks_p_value, train_rows,
    test_rows, exact. The p-value is exact where neither side has more than ``exact_rows``
    rows, else asymptotic. Groups with an empty side drop out."""
    is_train, is_test = F.col(split) == train, F.col(split) == test
    counts = df.where(F.col(value).isNotNull()).groupBy(*groups, F.col(value).alias("value")).agg(
        F.count_if(is_train).alias("train"), F.count_if(is_test).alias("test")
    )
    ranked = running_sums(counts, groups, "value", ["train", "test"]).where("total_train > 0 AND total_test > 0")
    gap = F.abs(F.col("cum_train") / F.col("total_train") - F.col("cum_test") / F.col("total_test"))
    found = ranked.groupBy(*groups).agg(F.max(gap).alias("ks_stat"), F.sum("train").alias("train_rows"), F.sum("test").alias("test_rows"))
    exact = F.greatest("train_rows", "test_rows") <= exact_rows
    sides = F.col("ks_stat"), F.col("train_rows"), F.col("test_rows")
    # Sides beyond the bound count as one row in the branch that is not taken.
    small = [F.when(exact, c).otherwise(F.lit(1).cast("long")) for c in sides[1:]]
    p = F.when(exact, exact_ks_p_value(sides[0], *small)).otherwise(ks_p_value(*sides))
    return found.select(*groups, "ks_stat", p.alias("ks_p_value"), "train_rows", "test_rows", exact.alias("exact"))



def _sides(df: DataFrame, columns: list[str], split: str, train: str, test: str) -> DataFrame:
    """Shares of every category on both sides; 0 where a side lacks it."""
    counts = category_counts(df, columns, [split])
    wide = counts.groupBy("feature", "value").agg(
        F.sum(F.when(F.col(split) == train, F.col("n")).otherwise(0)).alias("train"),
        F.sum(F.when(F.col(split) == test, F.col("n")).otherwise(0)).alias("test"),
    )
    return wide


def categorical_shift(df: DataFrame, columns: list[str], split: str, train: str, test: str) -> DataFrame:
    """Category counts, categories unseen in training, total variation distance."""
    wide = _sides(df, columns, split, train, test)
    totals = wide.groupBy("feature").agg(F.sum("train").alias("_t"), F.sum("test").alias("_s"))
    # One row per feature.
    shares = wide.join(F.broadcast(totals), "feature")
    gap = F.abs(F.col("train") / F.col("_t") - F.col("test") / F.col("_s"))
    return shares.groupBy("feature").agg(
        F.count_if(F.col("train") > 0).alias("n_train_categories"),
        F.count_if(F.col("test") > 0).alias("n_test_categories"),
        F.count_if((F.col("train") == 0) & (F.col("test") > 0)).alias("unseen_categories_in_test"),
        (F.sum(gap) / 2).alias("total_variation_distance"),
    )


def unseen_categories(train: DataFrame, test: DataFrame, column: str) -> DataFrame:
    """Values of the test period that training never saw."""
    # Distinct first, so hot values meet as single rows.
    new = test.select(column).distinct()
    known = train.select(F.col(column).alias("_k")).distinct()
    return new.join(known, F.col(column).eqNullSafe(F.col("_k")), "left_anti")


def split_summary(df: DataFrame, split: str, late: str, minutes: str) -> DataFrame:
    """Rows, late rate, mean and median delay per split."""
    base = df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.col(late).cast("int")).alias("delay_rate"),
        F.avg(minutes).alias("avg_delay_min"),
    )
    middle = median(df, [split], minutes).withColumnRenamed("median", "median_delay_min")
    return base.join(middle, split, "left")
