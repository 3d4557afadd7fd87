"""Session set-up and the shared folder that jobs write to."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cores: str = "*", name: str = "spendlake", shuffle_partitions: int = 8, folder: str | None = None
) -> SparkSession:
    """A session for tests and the bench; on a cluster use the session it supplies. ``folder`` takes what jobs store."""
    builder = SparkSession.builder.config("spark.checkpoint.dir", folder) if folder else SparkSession.builder
    spark = (
        builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="spendlake-")


def run_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/spendlake/{label}-{uuid.uuid4().hex}"


# Bytes of different values that a parquet column may hold once for many rows, where Spark's writers would stop at 1 MB.
_REPEATS = 64 << 20


def keep_repeats_once(spark: SparkSession) -> None:
    """From now on parquet files of this session have a long value that comes in many rows once per row group, not once per row.

    It is how files are encoded; rows stay the same. A larger size that the session has already is kept.
    """
    if int(spark.conf.get("parquet.dictionary.page.size", "0")) < _REPEATS:
        spark.conf.set("parquet.dictionary.page.size", str(_REPEATS))


# Folders written by ``stored`` in this process.
_STORED: list[str] = []


@contextlib.contextmanager
def stored_tables(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Drops what ``stored`` wrote within the block, once the job has written its result.

    Stored frames that are put into the list it gives stay.
    """
    first, kept = len(_STORED), []
    try:
        yield kept
    finally:
        dropped, _STORED[first:] = _STORED[first:], []
        stay = {frame.stored_at for frame in kept}
        for folder in dropped:
            if folder not in stay:
                _delete(spark, folder)
        _STORED.extend(folder for folder in dropped if folder in stay)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    For results that several later steps read: they are computed once, survive lost
    executors, and later joins know their true size. They stay until the ``stored_tables`` block
    around the job ends or ``drop_stored`` drops them, or for good without either.
    """
    path = run_dir(frame.sparkSession, label)
    _STORED.append(path)
    frame.write.parquet(path)
    kept = frame.sparkSession.read.schema(frame.schema).parquet(path)
    kept.stored_at = path
    return kept


def drop_stored(frame: DataFrame) -> None:
    """Drops what ``stored`` wrote for ``frame``. Call it once all that is made from it is stored itself."""
    _delete(frame.sparkSession, frame.stored_at)
