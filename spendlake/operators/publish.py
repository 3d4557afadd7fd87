"""Versioned full refresh: fill a new version, check it, make it current, drop the old ones.

A version is a parquet folder ``<name>_<yyyymmddHHMMSS>``. It becomes current when
an empty marker with its name is created, which every file system does in one step;
the newest marker is the current version. Readers see the old version until then.

Before its first file a version is noted as started. A killed job leaves a folder that is started and never
published; the next publish drops it, once it is older than a grace time.
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class VersionedTable:
    def __init__(self, spark: SparkSession, folder: str, name: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.name = name
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = hadoop.Path(self.folder).getFileSystem(conf)

    def publish(
        self,
        rows: DataFrame,
        now: datetime,
        schema: StructType | None = None,
        keep: int = 0,
        sort_by: Sequence[str] = (),
        grace: timedelta = timedelta(days=1),
    ) -> str:
        """Write ``rows`` as the new current version; ``keep`` older versions stay for readers still on them.

        Columns of a ``schema`` (say, of an index mapping) are written in its types, all others as they
        are. ``sort_by`` deals the rows over files by ranges and sorts each, so that a range
        filter on those columns skips whole files. What a publish started ``grace`` before ``now`` or earlier
        and never finished is dropped.
        """
        if schema is not None:
            mapped = {f.name: F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields}
            rows = rows.select(*[mapped.get(name, F.col(name)) for name in rows.columns])
        if sort_by:
            rows = rows.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
        version = f"{self.name}_{now:%Y%m%d%H%M%S}"
        if version in self.versions():
            raise ValueError(f"version {version} is already published")
        path = f"{self.folder}/{version}"
        self._drop_unfinished(now - grace)
        self._create(self._started(version))
        try:
            written = Observation()
            counted = rows.observe(written, F.count(F.lit(1)).alias("rows"))
            counted.write.mode("errorifexists").parquet(path)
            stored = self.spark.read.parquet(path).count()
            if stored != written.get["rows"]:
                raise RuntimeError(f"{version}: {written.get['rows']} rows given, {stored} stored")
            self._create(self._marker(version))
        except Exception:
            self._fs.delete(self._path(path), True)
            raise
        finally:
            self._fs.delete(self._path(self._started(version)), False)
        older = [v for v in self.versions() if v < version]
        for old in older[: len(older) - keep]:
            self._fs.delete(self._path(self._marker(old)), False)
            self._fs.delete(self._path(f"{self.folder}/{old}"), True)
        return version

    def versions(self) -> list[str]:
        """Published versions, oldest first."""
        return self._listed("_published")

    def read(self) -> DataFrame:
        versions = self.versions()
        if not versions:
            raise LookupError(f"no version of {self.name} is published")
        return self.spark.read.parquet(f"{self.folder}/{versions[-1]}")

    def _drop_unfinished(self, before: datetime) -> None:
        """Folders of versions that were started up to ``before`` and are not published."""
        published = self.versions()
        for version in self._listed("_started"):
            if datetime.strptime(version[-14:], "%Y%m%d%H%M%S") <= before:
                if version not in published:
                    self._fs.delete(self._path(f"{self.folder}/{version}"), True)
                self._fs.delete(self._path(self._started(version)), False)

    def _listed(self, folder: str) -> list[str]:
        """Names of this table's versions with a marker in the folder."""
        markers = self._path(posixpath.join(self.folder, folder))
        if not self._fs.exists(markers):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(markers)]
        return sorted(name for name in names if re.fullmatch(rf"{re.escape(self.name)}_\d{{14}}", name))

    def _create(self, marker: str) -> None:
        self._fs.create(self._path(marker), False).close()

    def _marker(self, version: str) -> str:
        return posixpath.join(self.folder, "_published", version)

    def _started(self, version: str) -> str:
        return posixpath.join(self.folder, "_started", version)
