"""Small helpers that the operators of this package share."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterable
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from slotwise.session import configure, new_work_dir

# The white space of all operators here: space, tab, line feed, VT, FF, carriage return.
SPACE = r"[\x20\x09-\x0D]"
ROW = "_row"

_collecting: list[list[str]] = []
_shipped: set[str] = set()
BATCH_ROWS = 2048


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, which may have no other way to import it,
    and let them have texts in short batches."""
    # Batches of long texts should not fill a worker's memory.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        home = Path(__file__).resolve().parents[2]
        packed = shutil.make_archive(f"{tempfile.mkdtemp(prefix='slotwise-')}/slotwise", "zip", home, "slotwise")
        context.addPyFile(packed)
        _shipped.add(context.applicationId)


def written(df: DataFrame, label: str, group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; see ``collecting``. A task that
    writes holds a row group; ``group_bytes`` bounds it where tasks need their memory otherwise."""
    path = new_work_dir(df.sparkSession, label)
    writer = df.write.mode("errorifexists")
    (writer.option("parquet.block.size", group_bytes) if group_bytes else writer).parquet(path)
    for paths in _collecting:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def collecting():
    """The paths of the tables that ``written`` makes inside, for ``discard`` later on."""
    paths: list[str] = []
    _collecting.append(paths)
    try:
        yield paths
    finally:
        _collecting.remove(paths)


def discard(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete working tables. Whatever was planned from them must have been written before."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text as it is; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_name(columns: list[str], name: str) -> str:
    """``name``, with as many underscores after it as make it no name among ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame) -> DataFrame:
    """Add a row number that tells equal rows apart, and write the rows with it.

    The number depends on how a scan is split, and a later scan of the same files may be
    split otherwise. So it is given once, and whatever needs the rows reads them from the
    written table. An input column of that name is kept under a free one, from where
    ``without_rows`` takes it back.
    """
    given = free_name(docs.columns, ROW)
    docs = docs.toDF(*[given if c.lower() == ROW else c for c in docs.columns])
    return written(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered-rows")


def with_text(rows: DataFrame) -> DataFrame:
    """The columns (_row, doc_id, text) of numbered ``rows``; null text is empty."""
    return rows.select(ROW, F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


def without_rows(rows: DataFrame, dropped: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of the numbered ``rows`` but those whose number is in ``dropped``."""
    given = free_name(columns, ROW)
    left = rows.join(dropped.select(ROW), ROW, "left_anti")
    return left.select(*[F.col(f"`{given if c.lower() == ROW else c}`").alias(c) for c in columns])


def fold(modulus: int, name: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def pieces(batches, limit_rows: int, limit_bytes: int, column: str = "text"):
    """Cut arrow batches into tables of bounded rows and text bytes; a row stays whole."""
    held, rows, size = [], 0, 0
    for batch in batches:
        lengths = np.diff(np.frombuffer(_offsets(batch.column(column)), dtype=np.int64)) if batch.num_rows else []
        start = 0
        for i, n in enumerate(lengths):
            if rows and (rows + 1 > limit_rows or size + n > limit_bytes):
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(held)
                held, rows, size, start = [], 0, 0, i
            rows, size = rows + 1, size + int(n)
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _offsets(array) -> bytes:
    lengths = pc.binary_length(array).fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64).tobytes()


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit numbers, one to one (multiply, shift, xor)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def summed(partials: DataFrame, fan_in: int = 16) -> np.ndarray | None:
    """Sum matrices of one shape, given as rows (part long, value binary of doubles).

    Adds in two rounds of tasks, so neither a task nor the driver meets more than
    ``fan_in`` times the square root of the partial matrices' number.
    """

    def add(tab: pa.Table) -> pa.Table:
        total = None
        for chunk in tab.column("value").to_pylist():
            row = np.frombuffer(chunk, dtype=np.float64)
            total = row.copy() if total is None else total + row
        return pa.table({"part": tab.column("part").slice(0, 1), "value": pa.array([total.tobytes()], pa.binary())})

    schema = "part long, value binary"
    for n in (fan_in * fan_in, fan_in):
        partials = partials.select(F.pmod("part", F.lit(n)).alias("part"), "value").groupBy("part").applyInArrow(add, schema)
    rows = partials.collect()
    return sum(np.frombuffer(r.value, dtype=np.float64) for r in rows) if rows else None


def partition_number() -> int:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0


