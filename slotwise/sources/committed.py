"""Tables whose rows and read position become visible together.

A run writes its rows into a folder of its own, which nobody reads yet, and then publishes a
version: a small file that lists the folders of the table and holds the position after the
run. The file is written under another name and renamed, which happens wholly or not at all
and fails if that version exists. So a reader, and a run that starts again, always meet the
rows and the position of one and the same version, wherever a run was killed. What killed
runs leave behind is never read and can be deleted at any later time.

The list grows by one folder a run; ``compact`` writes the rows of many runs into one folder.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from slotwise.sources.incremental import rows_after


class Conflict(RuntimeError):
    """Another run published the version first; run again from the new one."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    folders: tuple[str, ...] = ()
    position: int | None = None
    schema: str | None = None


class CommittedTable:
    """A table in ``path``, on a store whose rename is atomic, as HDFS and local disks have it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = spark.sparkContext._jvm.org.apache.hadoop.fs

    # ---- reading

    def version(self, number: int | None = None) -> Version:
        """The newest version, or the one of that number; number 0 is the empty table."""
        newest = max(self._numbers(), default=0)
        number = newest if number is None else number
        if number == 0:
            return Version()
        if number > newest:
            raise ValueError(f"there is no version {number}")
        text = self.spark.read.text(self._name(number), wholetext=True).first()[0]
        held = json.loads(text)
        return Version(number, tuple(held["folders"]), held["position"], held["schema"])

    def read(self, version: Version | None = None) -> DataFrame | None:
        """Rows of a version, by default the newest; None before the first one."""
        version = version or self.version()
        if version.schema is None:
            return None
        schema = StructType.fromJson(json.loads(version.schema))
        if not version.folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/rows/{f}" for f in version.folders])

    # ---- writing

    def append(self, rows: DataFrame, position: int | None, base: Version) -> Version:
        """Add ``rows`` to version ``base`` and move the position; None keeps it."""
        folder = self._write_rows(rows)
        return self._publish(Version(base.number + 1, (*base.folders, folder), base.position if position is None else position, rows.schema.json()))

    def advance(self, source: DataFrame, id_col: str, limit: int | None = None) -> Version:
        """One run: the rows of ``source`` past the position, and their largest id as the new one.

        The position is taken from the written rows, so rows that arrive in ``source``
        meanwhile are left to the next run. Without new rows there is no new version.
        """
        base = self.version()
        fresh = rows_after(source, id_col, base.position, limit)
        folder = self._write_rows(fresh)
        written = self.spark.read.schema(fresh.schema).parquet(f"{self.path}/rows/{folder}")
        position = written.agg(F.max(id_col)).first()[0]
        if position is None:
            self._delete(f"rows/{folder}")
            return base
        return self._publish(Version(base.number + 1, (*base.folders, folder), position, fresh.schema.json()))

    def compact(self) -> Version:
        """All rows of the newest version in one folder, in a version of the same position."""
        base = self.version()
        if len(base.folders) < 2:
            return base
        folder = self._write_rows(self.read(base))
        return self._publish(Version(base.number + 1, (folder,), base.position, base.schema))

    def replace(self, rows: DataFrame, base: Version) -> Version:
        """``rows`` instead of those of version ``base``, in a version of the same position."""
        folder = self._write_rows(rows)
        return self._publish(Version(base.number + 1, (folder,), base.position, rows.schema.json()))

    def clear(self, keep: int = 2) -> list[str]:
        """Delete folders that none of the newest ``keep`` versions lists, with all older versions.

        Not while a run is under way: its folder is in no version yet.
        """
        numbers = sorted(self._numbers())
        held = {f for n in numbers[-keep:] for f in self.version(n).folders}
        gone = [name for name in self._list("rows") if name not in held]
        for name in [f"versions/{n:012d}" for n in numbers[:-keep]] + [f"rows/{name}" for name in gone]:
            self._delete(name)
        return gone

    def _delete(self, name: str) -> None:
        at = self._at(f"{self.path}/{name}")
        at.getFileSystem(self._conf()).delete(at, True)

    def _write_rows(self, rows: DataFrame) -> str:
        folder = uuid.uuid4().hex
        rows.write.mode("errorifexists").parquet(f"{self.path}/rows/{folder}")
        return folder

    def _publish(self, version: Version) -> Version:
        draft, name = f"{self.path}/drafts/{uuid.uuid4().hex}", self._name(version.number)
        self._write_draft(draft, version)
        self._rename(draft, name)
        return version

    def _write_draft(self, draft: str, version: Version) -> None:
        held = {"folders": version.folders, "position": version.position, "schema": version.schema}
        at = self._at(draft)
        out = at.getFileSystem(self._conf()).create(at, False)
        try:
            out.write(bytearray(json.dumps(held).encode()))
        finally:
            out.close()

    def _rename(self, draft: str, name: str) -> None:
        source, target = self._at(draft), self._at(name)
        source.getFileSystem(self._conf()).mkdirs(target.getParent())
        context = self._fs.FileContext.getFileContext(source.toUri(), self._conf())
        kind = self._fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            context.rename(source, target, options)
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                raise Conflict(name) from error
            raise

    # ---- names

    def _name(self, number: int) -> str:
        return f"{self.path}/versions/{number:012d}"

    def _numbers(self) -> list[int]:
        return [int(name) for name in self._list("versions")]

    def _list(self, what: str) -> list[str]:
        """Names in a folder of the table: one a run since ``clear``."""
        at = self._at(f"{self.path}/{what}")
        files = at.getFileSystem(self._conf())
        return [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []

    def _at(self, path: str):
        return self._fs.Path(path)

    def _conf(self):
        return self.spark.sparkContext._jsc.hadoopConfiguration()
