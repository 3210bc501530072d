"""Training rows from a table, a query or a CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slotwise.schemas import TARGET_CLASS, TARGET_MINUTES, TIME_COLUMN


def labelled_table(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a feature table whose targets are known."""
    return spark.read.parquet(path).dropna(subset=[TARGET_MINUTES, TARGET_CLASS])


def query_rows(spark: SparkSession, query: str) -> DataFrame:
    """Any Spark SQL query as the source."""
    return spark.sql(query)


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """A CSV export with a header. One pass over the file infers the column types;
    the time stays text until it is validated."""
    rows = spark.read.option("header", True).option("inferSchema", True).csv(path)
    if TIME_COLUMN in rows.columns:
        rows = rows.withColumn(TIME_COLUMN, F.col(TIME_COLUMN).cast("string"))
    return rows


def not_empty(rows: DataFrame) -> DataFrame:
    if rows.isEmpty():
        raise ValueError("the training source returned no rows")
    return rows
