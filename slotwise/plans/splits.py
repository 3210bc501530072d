"""Time-ordered splits found by position, without numbering the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotwise.operators.ranks import before_key, nth_keys, running_sums, value_counts


def cutoff_micros(df: DataFrame, order: str, test_size: float = 0.2) -> tuple[int, int]:
    """Order value at position floor(n * (1 - test_size)) and n; fails on an empty side."""
    if not 0 < test_size < 1:
        raise ValueError("test_size must lie between 0 and 1")
    counts = value_counts(df, [], order)
    n = counts.agg(F.sum("n")).first()[0] or 0
    position = int(n * (1 - test_size))
    if position <= 0 or position >= n:
        raise ValueError("the split leaves train or test empty")
    ranked = running_sums(counts, [], order, ["n"])
    hit = ranked.where((F.col("cum_n") > position) & (F.col("cum_n") - F.col("n") <= position))
    row = hit.select(order, (F.col("cum_n") - F.col("n")).alias("before")).first()
    if row["before"] == 0:
        raise ValueError("the split leaves train empty: the first time stamp holds the cutoff")
    return row[order], n


def with_split(df: DataFrame, ts: str, test_size: float = 0.2) -> DataFrame:
    """Column ``split``: ``train`` strictly before the cutoff time, ``test`` from it
    on. Equal times stay together."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    cutoff, _ = cutoff_micros(df.select(micros.alias("_o")), "_o", test_size)
    return df.withColumn("split", F.when(micros < cutoff, "train").otherwise("test"))


def chronological_split(
    df: DataFrame, ts: str, test_size: float = 0.2
) -> tuple[DataFrame, DataFrame, int]:
    """Train rows, test rows and the cutoff in microseconds."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    cutoff, _ = cutoff_micros(df.select(micros.alias("_o")), "_o", test_size)
    return df.where(micros < cutoff), df.where(micros >= cutoff), cutoff


def positional_split(
    df: DataFrame, order: str, tie: str, train_share: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """First floor(n * share) rows by (order, tie), and the rest."""
    n = df.count()
    position = int(n * train_share)
    if position <= 0 or position >= n:
        raise ValueError("the split leaves one side empty")
    key = nth_keys(df, order, tie, [position])[0]
    early = before_key(F.col(order), F.col(tie), key)
    return df.where(early), df.where(~early)


def expanding_folds(df: DataFrame, order: str, tie: str, folds: int = 4) -> DataFrame:
    """Column ``fold``: 0 for rows that are only ever trained on, else the fold
    that tests the row. Fold f trains on all rows with a smaller number."""
    n = df.count()
    size = n // (folds + 1)
    if size == 0:
        raise ValueError("too few rows for the folds")
    starts = [n - (folds - i) * size for i in range(folds)]
    keys = nth_keys(df, order, tie, starts)
    fold = F.lit(0)
    for i, key in enumerate(keys, start=1):
        fold = F.when(~before_key(F.col(order), F.col(tie), key), i).otherwise(fold)
    return df.withColumn("fold", fold)
