"""Incremental scans over an ordered id, with the position kept in a state table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slotwise.operators.upsert import table_exists


def read_cursor(spark: SparkSession, state: str, table_name: str) -> int:
    """Last processed id of a table, 0 when it was never read."""
    if not table_exists(spark, state):
        return 0
    last = spark.read.parquet(state).where(F.col("table_name") == table_name).agg(F.max("last_id"))
    return last.first()[0] or 0


def advance_cursor(spark: SparkSession, state: str, table_name: str, last_id: int) -> None:
    """Record a new position. Positions are appended, the largest one counts."""
    spark.range(1).select(
        F.lit(table_name).alias("table_name"),
        F.lit(last_id).cast("long").alias("last_id"),
        F.current_timestamp().alias("updated_at"),
    ).write.mode("append").parquet(state)


def rows_after(table: DataFrame, id_col: str, last_id: int | None, limit: int | None = None) -> DataFrame:
    """Rows past a position, all rows if there is none; a bounded chunk only on request."""
    fresh = table if last_id is None else table.where(F.col(id_col) > last_id)
    return fresh if limit is None else fresh.orderBy(id_col).limit(limit)


def rows_between(table: DataFrame, ts: str, start, end, required: list[str]) -> DataFrame:
    """Half-open time window; rows without the required columns drop out."""
    return table.where((F.col(ts) >= start) & (F.col(ts) < end)).dropna(subset=required)


def overlapping(table: DataFrame, start_col: str, end_col: str, start, end) -> DataFrame:
    """Intervals that touch the closed window; open-ended ones drop out."""
    return table.where((F.col(start_col) <= end) & (F.col(end_col) >= start))
