"""Substring search over a numbered table by trigrams of the distinct values of its fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from slotwise.plans.scoring import SEARCH_COLUMNS, SEARCH_FIELDS
from slotwise.sources.numbered import NumberedTable

# Up to so many found values are put into the filter of the scan; more are joined.
LISTED_VALUES = 1000


def grams(text: Column) -> Column:
    """Distinct runs of three characters; none in shorter texts."""
    found = F.transform(F.sequence(F.lit(1), F.length(text) - 2), lambda i: F.substr(text, i, F.lit(3)))
    return F.when(F.length(text) >= 3, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


class SearchIndex:
    """Three tables next to the rows: trigrams of the distinct values of a field, these values,
    and the rows of each value. All are sorted by what is looked up in them, so a search reads
    the lists of its trigrams, of the values they leave, and the folders of the rows shown.
    Rows are numbered in the order in which a search shows them: its first rows are those of the
    smallest numbers, found before any row is read."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.table = NumberedTable(spark, f"{self.path}/table")

    @classmethod
    def build(cls, rows: DataFrame, path: str, order: list[str], parts: int | None = None) -> SearchIndex:
        index = cls(rows.sparkSession, path)
        NumberedTable.write(rows, f"{index.path}/table", order, parts)
        fields = {f: c for f, names in SEARCH_FIELDS.items() for c in reversed(names) if c in rows.columns}
        entries = [F.struct(F.lit(f).alias("field"), F.lower(F.col(c)).alias("value")) for f, c in fields.items()]
        if not entries:
            raise ValueError(f"none of the searched columns is in {rows.columns}")
        listed = index.table.rows().select(F.explode(F.array(*entries)).alias("e"), "part", "pos")
        index._write(listed.select("e.*", "part", "pos").where("value is not null"), "postings", ["field", "value", "part", "pos"])
        index._write(index._read("postings").groupBy("field", "value").count(), "values", ["field", "value"])
        spelled = index._read("values").select("field", F.explode(grams(F.col("value"))).alias("gram"), "value")
        index._write(spelled, "grams", ["field", "gram", "value"])
        return index

    def search(self, limit: int = 10, **wanted: str | None) -> DataFrame:
        """The same rows as ``scoring.search`` in the order of the table, with ``row_id``. The
        places of the ``limit`` rows shown come to the driver, no others."""
        asked = {f: str(t) for f, t in wanted.items() if t is not None}
        columns = self.table.rows().columns
        known = all(any(c in columns for c in SEARCH_FIELDS[f]) for f in asked)
        hits = [self._hits(f, t) for f, t in asked.items()] if known else []
        found = reduce(lambda a, b: a.join(b, ["part", "pos"]), hits) if hits else self.table.rows().select("part", "pos")
        first = found.orderBy("part", "pos").limit(limit).collect() if known else []
        rows = self.table.rows().where(_any_of(first))
        shown = self.table.numbered(rows)
        return shown.orderBy("row_id").select(*[c for c in SEARCH_COLUMNS if c in shown.columns])

    def matching_values(self, field: str, text: str) -> DataFrame:
        """Distinct values of a field that contain the text: those that hold all its trigrams,
        looked at once more. Texts below three characters are looked for in all values."""
        lower = F.lower(F.lit(text))
        parts = self.spark.range(1).select(grams(lower)).first()[0]
        if parts:
            listed = self._read("grams").where((F.col("field") == field) & F.col("gram").isin(parts))
            values = listed.groupBy("value").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") == len(parts))
        else:
            values = self._read("values").where(F.col("field") == field)
        return values.where(F.contains("value", lower)).select("value")

    def _hits(self, field: str, text: str) -> DataFrame:
        values = self.matching_values(field, text)
        few = [r.value for r in values.limit(LISTED_VALUES + 1).collect()]
        listed = self._read("postings").where(F.col("field") == field)
        if len(few) <= LISTED_VALUES:
            return listed.where(F.col("value").isin(few)).select("part", "pos")
        return listed.join(values, "value", "left_semi").select("part", "pos")

    def _write(self, rows: DataFrame, name: str, order: list[str]) -> None:
        rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{self.path}/{name}")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")


def _any_of(places: list) -> Column:
    by_part: dict[int, list[int]] = {}
    for place in places:
        by_part.setdefault(place.part, []).append(place.pos)
    chosen = [(F.col("part") == part) & F.col("pos").isin(pos) for part, pos in by_part.items()]
    return reduce(lambda a, b: a | b, chosen, F.lit(False))
