"""Append-only raw tables to keyed silver tables, micro-batch by micro-batch."""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from slotwise.operators.upsert import replay, rewrite_partitions, table_exists
from slotwise.plans.silver import clean_airports, flatten_flights, flatten_notams
from slotwise.schemas import (
    AIRPORT_KEY, AIRPORT_MUTABLE, FLIGHT_KEY, FLIGHT_MUTABLE, NOTAM_KEY, NOTAM_MUTABLE,
)
from slotwise.streaming.landing import start


@dataclass(frozen=True)
class Entity:
    """How raw rows become keyed rows. ``partition_value`` gets the number of key-hash parts."""

    flatten: Callable[[DataFrame, list[str]], DataFrame]
    keys: list[str]
    mutable: list[str]
    partition: str
    partition_value: Callable[[int], Column]


def _key_partition(key: str) -> Callable[[int], Column]:
    """``3_of_64``: the value names the number of parts, so a table tells its own layout."""
    return lambda parts: F.concat(F.pmod(F.xxhash64(key), F.lit(parts)), F.lit(f"_of_{parts}"))


FLIGHTS = Entity(
    flatten_flights, FLIGHT_KEY, FLIGHT_MUTABLE, "dep_date", lambda parts: F.to_date("dep_scheduled_utc")
)
NOTAMS = Entity(flatten_notams, NOTAM_KEY, NOTAM_MUTABLE, "key_part", _key_partition("notam_number"))
AIRPORTS = Entity(clean_airports, AIRPORT_KEY, AIRPORT_MUTABLE, "key_part", _key_partition("iata_code"))


def key_parts(spark: SparkSession, table: str, wanted: int | None = None) -> int:
    """Parts of a key-hashed table: what the table was made with, for a new one ``wanted``
    (choose it for the size the table will have; default one per shuffle partition)."""
    if table_exists(spark, table):
        made = spark.read.parquet(table)
        found = made.select("key_part").first() if "key_part" in made.columns else None
        if found:
            return int(found[0].split("_of_")[1])
    return wanted or int(spark.conf.get("spark.sql.shuffle.partitions"))


def promote_batch(
    raw: DataFrame, entity: Entity, table: str, order: list[str], parts: int | None = None
) -> None:
    """Flatten, fold the landed batches of each key into one row, upsert the touched partitions.

    The first column of ``order`` names the landed batch. Within one the last row of a key
    counts; over batches mutable columns come from the last, the others from the first, so
    it does not matter how many landed batches one micro-batch holds.
    """
    flat = entity.flatten(raw, order)
    value = entity.partition_value(key_parts(raw.sparkSession, table, parts))
    rows = replay(flat, entity.keys, entity.mutable, order[0], order).withColumns(
        {entity.partition: value, "updated_at": F.current_timestamp()}
    )
    mutable = [*entity.mutable, "updated_at"]
    rewrite_partitions(rows, table, entity.keys, mutable, entity.partition)


def promote(
    spark: SparkSession,
    raw_table: str,
    entity: Entity,
    table: str,
    checkpoint: str,
    order: list[str],
    parts: int | None = None,
) -> StreamingQuery:
    """Follow ``raw_table``; each micro-batch is one upsert, repeats are harmless. ``parts``:
    see ``key_parts``."""
    schema = spark.read.parquet(raw_table).schema
    stream = spark.readStream.schema(schema).parquet(raw_table)

    def write(batch: DataFrame, batch_id: int) -> None:
        promote_batch(batch, entity, table, order, parts)

    return start(stream, write, checkpoint)
