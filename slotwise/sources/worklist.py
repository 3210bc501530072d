"""Work list of an extract: airports x directions x date chunks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F


def add_chunks(spans: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """Cut the inclusive date span of every row into chunks of at most ``days`` days:
    ``chunk_from``, ``chunk_to``. An empty span gives no rows."""
    step = F.make_dt_interval(F.lit(days))
    return (
        spans.where(F.col(start) <= F.col(end))
        .select("*", F.explode(F.sequence(start, F.greatest(start, end), step)).alias("chunk_from"))
        .withColumn("chunk_to", F.least(F.date_add("chunk_from", days - 1), F.col(end)))
    )


def date_chunks(spark: SparkSession, start: date, end: date, days: int) -> DataFrame:
    span = spark.range(1).select(F.lit(start).alias("a"), F.lit(end).alias("b"))
    return add_chunks(span, "a", "b", days).select("chunk_from", "chunk_to")


def extract_plan(
    airports: DataFrame, airport: str, directions: list[str], start: date, end: date, days: int
) -> DataFrame:
    """One row per request. The lists are configuration, so each row just unrolls them."""
    each = airports.select(
        F.col(airport).alias("airport"),
        F.explode(F.lit(directions)).alias("direction"),
        F.lit(start).alias("_start"),
        F.lit(end).alias("_end"),
    )
    return add_chunks(each, "_start", "_end", days).drop("_start", "_end")
