"""CSV snapshots of the airport reference table, loaded once per file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from slotwise.functions.casts import blank_to_null
from slotwise.operators.upsert import table_exists
from slotwise.schemas import AIRPORT_CSV_COLUMNS


def read_airport_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, empty text as NULL, tagged with the file name.

    Columns are matched by the header of each file, other columns are ignored. Files with
    the same header are read together; the driver only sees their names and headers.
    """
    # The content column of this source is pruned, so files are listed, not read.
    files = [r["path"] for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    by_header: dict[tuple, list[str]] = {}
    for file in files:
        header = tuple(spark.read.option("header", True).csv(file).columns)
        by_header.setdefault(header, []).append(file)
    if not by_header:
        raise ValueError(f"no airport snapshot at {path}")
    parts = [_read_same_header(spark, header, group) for header, group in by_header.items()]
    return reduce(DataFrame.unionByName, parts)


def _read_same_header(spark: SparkSession, header: tuple, files: list[str]) -> DataFrame:
    missing = [c for c in AIRPORT_CSV_COLUMNS if c not in header]
    if missing:
        raise ValueError(f"airport snapshot lacks columns: {missing}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", True)
        .csv(files)
    )
    file_name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return rows.select(
        *[
            blank_to_null(F.col(c)).alias("ourairports_id" if c == "id" else c)
            for c in AIRPORT_CSV_COLUMNS
        ],
        F.url_decode(file_name).alias("source_file"),
    )


def not_loaded_yet(incoming: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows of files whose name is not in ``loaded`` yet."""
    return incoming.join(loaded.select("source_file").distinct(), "source_file", "left_anti").select(
        incoming.columns
    )


def load_airport_snapshots(spark: SparkSession, csv_path: str, table: str) -> dict[str, int]:
    """Append new snapshot files to the raw airport table."""
    incoming = read_airport_csv(spark, csv_path)
    if table_exists(spark, table):
        incoming = not_loaded_yet(incoming, spark.read.parquet(table))
    added = incoming.withColumn("loaded_at", F.current_timestamp())
    counts = {"files": 0, "inserted": 0}
    stats = added.agg(
        F.count_distinct("source_file").alias("files"), F.count(F.lit(1)).alias("inserted")
    ).first()
    if stats["inserted"]:
        added.write.mode("append").parquet(table)
        counts = stats.asDict()
    return counts
