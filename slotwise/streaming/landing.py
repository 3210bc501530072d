"""Raw feeds to append-only tables, as a stream that stops when the input is drained."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from slotwise.sources.envelope import decode, split_decoded

def landing_files(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Stream of JSON lines in ``folder`` with the place each line came from.

    A topic source delivers the same ``value``; its place is partition and offset.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    place = F.struct(
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return reader.load(folder).select("value", place.alias("place"))


def _write_batch(rows: DataFrame, table: str, batch_id: int) -> None:
    """Replace the rows of one micro-batch, so a repeated batch changes nothing."""
    (
        rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(table)
    )


def land(
    stream: DataFrame,
    provenance: list[str],
    table: str,
    dead_letters: str,
    checkpoint: str,
    stats: dict[str, int] | None = None,
) -> StreamingQuery:
    """Decode envelopes; good rows to ``table``, undecodable text to ``dead_letters``.

    The position is committed after the batch was written (at least once), and
    the write is keyed by the batch number (so in effect once). ``stats`` receives
    the numbers of consumed, failed and inserted rows.
    """
    counted = {} if stats is None else stats
    counted.update({"consumed": 0, "failed": 0, "inserted": 0})

    def write(batch: DataFrame, batch_id: int) -> None:
        # Later files win over earlier ones, later lines over earlier lines.
        row = F.struct("place", F.monotonically_increasing_id().alias("row"))
        placed = batch.select("value", row.alias("arrival"))
        # Two writes and a count from one read of the source.
        decoded = decode(placed, provenance).persist()
        good, bad = split_decoded(decoded)
        _write_batch(good.withColumn("loaded_at", F.current_timestamp()), table, batch_id)
        _write_batch(bad, dead_letters, batch_id)
        ok = decoded.agg(F.count_if("decoded").alias("ok"), F.count(F.lit(1)).alias("n")).first()
        decoded.unpersist()
        counted["consumed"] += ok["n"]
        counted["inserted"] += ok["ok"]
        counted["failed"] += ok["n"] - ok["ok"]

    return start(stream, write, checkpoint)


def start(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain(query: StreamingQuery) -> None:
    """Wait until the input is drained; a failed batch raises here."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
