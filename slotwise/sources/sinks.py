"""Writers for full tables, small reports and job statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotwise.functions.casts import nan_to_null


def replace_table(rows: DataFrame, path: str, order: list[str]) -> dict[str, int]:
    """Overwrite a table and report the rows written, which the footers of its files tell.

    Files are sorted by ``order``, so readers can skip by its minimum and maximum. NaN is
    written as NULL.
    """
    numbers = [c for c, kind in rows.dtypes if kind in ("double", "float")]
    rows = rows.withColumns({c: nan_to_null(F.col(f"`{c}`")) for c in numbers})
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.write.mode("overwrite").parquet(path)
    # No observation: after one, Spark cannot send models that keep a training summary to its tasks.
    written = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return {"clean_rows": written.count(), "clean_columns": len(rows.columns)}


def write_report(rows: DataFrame, path: str) -> None:
    """A small result (metrics, one row per feature or model) as one CSV file."""
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
