"""A table whose rows carry their number in a total order, with an index of its parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

RESERVED = {"part", "pos", "first", "row_id"}


class NumberedTable:
    """Rows in ranges of ``order``, one folder a range (``part``), numbered inside it (``pos``).

    ``parts`` knows for each range its rows, the number of its first row and the bounds of the
    order columns, so a row or a range of the leading order column is found by reading only the
    folders that hold it. ``order`` should be a total order; rows equal in it stand as they
    were written. The index is written last: without it the folder is an unfinished table.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def write(cls, rows: DataFrame, path: str, order: list[str], parts: int | None = None) -> NumberedTable:
        """One shuffle into sorted ranges. ``parts`` ranges at most; by default as many as
        Spark makes of the size of the data. An existing table is an error, and so is a column
        that is named like one of the table's own (`RESERVED`)."""
        clash = RESERVED & set(rows.columns)
        if clash:
            raise ValueError(f"columns have reserved names: {sorted(clash)}")
        table = cls(rows.sparkSession, path)
        ranged = rows.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
        # An increasing id holds the range in its upper bits and the row in the lower 33.
        number = F.col("_number")
        placed = ranged.withColumn("_number", F.monotonically_increasing_id()).withColumns(
            {"part": F.shiftright(number, 33).cast("int"), "pos": number.bitwiseAND(F.lit((1 << 33) - 1))}
        )
        placed.drop("_number").write.partitionBy("part").parquet(f"{table.path}/rows")
        # Tells the columns of a table without rows.
        rows.limit(0).write.parquet(f"{table.path}/layout")
        written = table.rows()
        bounds = [
            f(c).alias(f"{name}_{i}") for i, c in enumerate(order) for f, name in ((F.min, "least"), (F.max, "most"))
        ]
        known = written.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.count(order[0]).alias("valued"), *bounds)
        # One row a range, so the window is as small as the list of folders.
        earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        first = F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first")
        known.select("*", first).coalesce(1).write.parquet(f"{table.path}/parts")
        return table

    def parts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/parts")

    def rows(self) -> DataFrame:
        """The rows with ``part`` and ``pos``."""
        layout = self.spark.read.parquet(f"{self.path}/layout").schema
        placed = [StructField("pos", LongType()), StructField("part", IntegerType())]
        return self.spark.read.schema(StructType([*layout.fields, *placed])).parquet(f"{self.path}/rows")

    def numbered(self, rows: DataFrame | None = None) -> DataFrame:
        """``rows`` of the table, by default all, with ``row_id`` for ``part`` and ``pos``."""
        rows = self.rows() if rows is None else rows
        first = self.parts().select("part", "first")
        return rows.join(first, "part").withColumn("row_id", F.col("first") + F.col("pos")).drop("part", "pos", "first")

    def row_at(self, position: int) -> DataFrame:
        """The row of that number, from one folder."""
        held = self.parts().where((F.col("first") <= position) & (F.col("first") + F.col("rows") > position)).first()
        if held is None:
            raise IndexError(f"row {position} is outside the table")
        wanted = (F.col("part") == held["part"]) & (F.col("pos") == position - held["first"])
        return self.numbered(self.rows().where(wanted))

    def between(self, column: str, low, high) -> DataFrame:
        """Rows with ``low <= column <= high``, ``column`` being the leading order column; only
        folders whose bounds meet the range are read."""
        meets = (F.col("valued") > 0) & (F.col("least_0") <= F.lit(high)) & (F.col("most_0") >= F.lit(low))
        held = [r.part for r in self.parts().where(meets).select("part").collect()]
        return self.numbered(self.rows().where(F.col("part").isin(held) & F.col(column).between(low, high)))
