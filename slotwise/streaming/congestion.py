"""Hourly counts and duplicate removal on an event-time stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from slotwise.operators.upsert import rewrite_partitions
from slotwise.streaming.landing import start


def hourly_counts(stream: DataFrame, ts: str, key: str, late_by: str = "7 days") -> DataFrame:
    """Rows per key and hour; rows later than ``late_by`` are not waited for."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late_by)
    counted = timed.groupBy(F.window(ts, "1 hour"), F.col(key)).count()
    return counted.select(
        F.col(key), F.col("window.start").alias("hour"), F.col("count").alias("flights")
    )


def without_redelivery(stream: DataFrame, ts: str, keys: list[str], late_by: str = "7 days") -> DataFrame:
    """First delivery per key within the watermark."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late_by)
    return timed.dropDuplicatesWithinWatermark(keys)


def maintain_hourly_counts(counts: DataFrame, table: str, key: str, checkpoint: str) -> StreamingQuery:
    """Keep a day-partitioned table of the counts up to date."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("day", F.to_date("hour"))
        rewrite_partitions(rows, table, [key, "hour"], ["flights"], "day")

    return start(counts, write, checkpoint, mode="update")
