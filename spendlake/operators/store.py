"""A keyed table of files that changes by commits; a commit rewrites only the files it touches.

A commit is one record: its number, the manifest that lists the table's files with their key and sort ranges,
and how much of the change feed is in it. The record is written under a name of its own and then
renamed to its number, which fails where the number is taken. So of two writers one comes first, and the other goes
on from the first one's table; rebuild, feed and compaction can go on side by side.

Data go to a new folder each time, noted before the first file is written. Folders and files that no kept commit
lists are dropped by ``sweep``, those of unfinished writers only after a grace time, so a killed job
leaves nothing for good.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spendlake.session import stored

# Changed keys are told apart by at most so many ranges when the manifest is asked for their files.
CELLS = 1024

# Columns that only the store sees: time of the event behind a row, and whether that was a delete.
EVENT_AT, GONE = "event_at", "is_gone"


class CommitConflict(Exception):
    """Another writer committed first."""


@dataclass(frozen=True)
class Commit:
    version: int
    manifest: str
    schema: str
    at: str
    last_batch: int = -1
    positions: dict[str, int] = field(default_factory=dict)


class SharedFolder:
    """A folder of a Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        if not self._fs.exists(self._at(name)):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._at(name)))

    def text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._at(name), False)
        stream.write(bytearray(text.encode()))
        stream.close()

    def publish(self, draft: str, name: str) -> None:
        """Renames ``draft`` to ``name`` in one step; a conflict if there is a ``name`` already."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self._conf)
        options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._at(draft), self._at(name), options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception.getClass().getName()):
                raise
            self.delete(draft)
            raise CommitConflict(name) from error

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


class IndexStore:
    """A table that is unique on the whole-number column ``key``; ``sort_by`` clusters its files.

    Rows remember the time of the event that wrote them, deletes included, so a later change with an
    earlier event does nothing. ``keep`` commits stay readable besides the latest. A sweep lists all data files, so for
    tables of very many files ``sweep_every`` lets it follow only every so many commits.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        key: str,
        sort_by: Sequence[str] = (),
        rows_per_file: int = 1_000_000,
        keep: int = 1,
        grace: timedelta = timedelta(days=1),
        sweep_every: int = 1,
    ) -> None:
        self.spark, self.key, self.sort_by = spark, key, list(sort_by)
        self.rows_per_file, self.keep, self.grace, self.sweep_every = rows_per_file, keep, grace, sweep_every
        self.folder = SharedFolder(spark, folder)

    # Reading

    def versions(self) -> list[int]:
        return [int(name) for name in self.folder.names("commits") if name.isdigit()]

    def commit(self, version: int) -> Commit:
        return Commit(**json.loads(self.folder.text(f"commits/{version:020d}")))

    def latest(self) -> Commit | None:
        versions = self.versions()
        return self.commit(versions[-1]) if versions else None

    def files(self, commit: Commit) -> DataFrame:
        """(path, rows, key_min, key_max and the range of the first sort column) of every file of the table."""
        return self.spark.read.parquet(f"{self.folder.path}/manifests/{commit.manifest}")

    def read(self, commit: Commit | None = None) -> DataFrame:
        """The rows of a commit, of the latest one by default."""
        commit = commit or self.latest()
        if commit is None:
            raise LookupError(f"nothing is committed in {self.folder.path}")
        paths = [row.path for row in self.files(commit).select("path").collect()]  # a name for each file
        return self._rows(commit, paths).filter(~F.col(GONE)).drop(EVENT_AT, GONE)

    def _rows(self, commit: Commit, paths: Sequence[str]) -> DataFrame:
        schema = StructType.fromJson(json.loads(commit.schema))
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder.path}/data/{path}" for path in paths])

    # Writing

    def publish(
        self,
        rows: DataFrame,
        now: datetime,
        last_batch: int = -1,
        positions: dict[int, int] | None = None,
        size: int | None = None,
    ) -> Commit:
        """``rows`` as the whole table. What other writers commit meanwhile is replaced with the rest.

        ``last_batch`` and ``positions`` say how much of the feed the rows hold: later batches are laid
        over the table by its readers, whoever wrote them. Where the number of rows is known, ``size`` says it, and files
        have ``rows_per_file``; else Spark cuts them by bytes.
        """
        rows = rows.withColumns({EVENT_AT: F.lit(None).cast("timestamp_ntz"), GONE: F.lit(False)})
        folder, schema, files = self._written(rows, size, now)
        while True:
            base = self.latest()
            try:
                return self._committed(base, folder, schema, files, now, last_batch, positions or {})
            except CommitConflict:
                continue

    def apply(
        self,
        changes: DataFrame,
        now: datetime,
        last_batch: int | None = None,
        positions: dict[int, int] | None = None,
        base: Commit | None = None,
        by_event_time: bool = True,
    ) -> Commit:
        """The table with ``changes`` (its columns, event_at, op), one row for each key; a conflict if ``base`` is not the latest.

        Files that hold none of the keys stay as they are. With ``by_event_time`` a row whose own event is as late
        or later stays. Without changes only the commit moves on.
        """
        base = base or self.latest()
        if base is None:
            raise LookupError("publish a table before changes")
        changes = stored(changes.withColumn(GONE, F.col("op") == "delete").drop("op"), "store-changes")
        touched, size = self._touched(base, changes)
        old = self._rows(base, touched)
        late = changes.select(self.key, F.col(EVENT_AT).alias("change_at"), F.lit(True).alias("changed"))
        met = old.join(late, self.key, "left")
        stays = F.col("changed").isNull()
        if by_event_time:
            stays = stays | F.coalesce(F.col(EVENT_AT) >= F.col("change_at"), F.lit(False))
        kept = met.filter(stays).select(old.columns)
        stale = met.filter(F.col("changed") & stays).select(self.key)
        merged = kept.unionByName(changes.join(stale, self.key, "left_anti").select(old.columns))
        folder, schema, files = self._written(merged, size, now) if size else (None, base.schema, None)
        untouched = self.files(base).filter(~F.col("path").isin(touched)) if touched else self.files(base)
        files = untouched if files is None else untouched.unionByName(files)
        batch = base.last_batch if last_batch is None else last_batch
        places = base.positions if positions is None else positions
        try:
            return self._committed(base, folder, schema, files, now, batch, places)
        except CommitConflict:
            if folder:
                self.folder.delete(f"data/{folder}")
                self.folder.delete(f"started/{folder}")
            raise

    def _touched(self, base: Commit, changes: DataFrame) -> tuple[list[str], int]:
        """The files that hold changed keys, and how many rows these and the changes have together."""
        ends = changes.agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.count(F.lit(1)).alias("n")).first()
        if not ends.n:
            return [], 0
        width = (ends.high - ends.low) // CELLS + 1
        cell = F.floor((F.col(self.key) - ends.low) / width)
        cells = [row[0] for row in changes.select(cell).distinct().collect()]  # CELLS + 1 at most
        starts = F.array(*[F.lit(ends.low + c * width) for c in cells])
        meets = F.exists(starts, lambda low: (F.col("key_max") >= low) & (F.col("key_min") < low + width))
        listed = self.files(base).filter(meets)
        possible = [row.path for row in listed.select("path").collect()]
        if not possible:
            return [], ends.n
        name = F.substring_index("_metadata.file_path", "/", -2).alias("path")
        rows = self._rows(base, possible).filter(F.col(self.key).between(ends.low, ends.high)).select(self.key, name)
        held = rows.join(changes.select(self.key), self.key, "left_semi").select("path").distinct()
        found = listed.join(held, "path", "left_semi").select("path", "rows").collect()
        return [row.path for row in found], ends.n + sum(row.rows for row in found)

    def _written(self, rows: DataFrame, size: int | None, now: datetime) -> tuple[str, str, DataFrame]:
        """A new data folder with the rows: its name, their schema and the list of its files."""
        folder = uuid.uuid4().hex
        self.folder.write(f"started/{folder}", now.isoformat())
        order = list(dict.fromkeys([*self.sort_by, self.key]))
        if size is None:  # as many files as Spark finds apt for their bytes
            dealt = rows.repartitionByRange(*order)
        else:
            dealt = rows.repartitionByRange(-(-size // self.rows_per_file), *order)
        seen = Observation()
        counted = dealt.sortWithinPartitions(*order).observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.parquet(f"{self.folder.path}/data/{folder}")
        first = order[0]
        listed = self.spark.read.schema(rows.schema).parquet(f"{self.folder.path}/data/{folder}")
        files = listed.groupBy(F.substring_index("_metadata.file_path", "/", -2).alias("path")).agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(self.key).alias("key_min"),
            F.max(self.key).alias("key_max"),
            F.min(first).alias("sort_min"),
            F.max(first).alias("sort_max"),
        )
        files = stored(files, "store-files")
        held = files.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        if held != seen.get["rows"]:
            raise RuntimeError(f"{seen.get['rows']} rows given, {held} stored")
        return folder, rows.schema.json(), files

    def _committed(
        self, base: Commit | None, folder: str | None, schema: str, files: DataFrame, now: datetime, last_batch: int, positions
    ) -> Commit:
        manifest = uuid.uuid4().hex
        files.coalesce(1).write.parquet(f"{self.folder.path}/manifests/{manifest}")  # a row for each file
        version = base.version + 1 if base else 1
        places = {str(partition): place for partition, place in positions.items()}
        commit = Commit(version, manifest, schema, now.isoformat(), last_batch, places)
        self.folder.write(f"commits/draft-{manifest}", json.dumps(commit.__dict__))
        try:
            self.folder.publish(f"commits/draft-{manifest}", f"commits/{version:020d}")
        except CommitConflict:
            self.folder.delete(f"manifests/{manifest}")
            raise
        if version % self.sweep_every == 0:
            self.sweep(now)
        return commit

    def sweep(self, now: datetime) -> list[str]:
        """Drops old commits and every data folder and file that the kept ones do not list; returns their names.

        What a writer has started less than ``grace`` before ``now`` and not committed yet stays.
        """
        versions = self.versions()
        for version in versions[: -1 - self.keep]:
            self.folder.delete(f"commits/{version:020d}")
        kept = [self.commit(version) for version in versions[-1 - self.keep :]]
        listed: dict[str, set[str]] = {}
        for commit in kept:
            for row in self.files(commit).select("path").collect():
                folder, file = row.path.split("/")
                listed.setdefault(folder, set()).add(file)
        started = {name: datetime.fromisoformat(self.folder.text(f"started/{name}")) for name in self.folder.names("started")}
        young = {name for name, at in started.items() if at > now - self.grace}
        gone = []
        for folder in self.folder.names("data"):
            if folder not in listed:
                if folder not in young:
                    gone.append(folder)
            else:
                files = [name for name in self.folder.names(f"data/{folder}") if name.startswith("part-")]
                gone += [f"{folder}/{name}" for name in files if name not in listed[folder]]
        for name in gone:
            self.folder.delete(f"data/{name}")
        for name in started:
            if name not in young and name not in listed:
                self.folder.delete(f"started/{name}")
        if not young - set(listed):  # else a manifest may belong to a commit that is being written
            manifests = {commit.manifest for commit in kept}
            for name in self.folder.names("manifests"):
                if name not in manifests:
                    self.folder.delete(f"manifests/{name}")
        return gone
