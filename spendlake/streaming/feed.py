"""The change feed as a stream: each micro-batch becomes one small change set.

A batch writes only what it changes, to a folder named by its batch id, and a batch
that runs again after a failure overwrites its own folder, so nothing is applied
twice. ``read_index`` lays the logged changes over an index; ``compact`` folds them into an ``IndexStore``,
whose commit notes the last batch in it, and ``read_current`` lays later batches over that. The
cost of a batch so follows the size of the batch, and that of folding the files that hold its keys.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spendlake.functions.dates import moment
from spendlake.operators import cdc
from spendlake.operators.offsets import Positions, next_positions
from spendlake.operators.store import Commit, CommitConflict, IndexStore, SharedFolder
from spendlake.schemas import GROUP_OFFSET, TABLES
from spendlake.sources.feed import decode_events

def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def start_feed(
    messages: DataFrame,
    tables: Callable[[], object],
    change_log: str,
    checkpoint: str,
    now: Callable[[], datetime] = _utc_now,
    strict: bool = False,
    trigger: dict | None = None,
    positions: str | None = None,
    group: str = "feed",
) -> StreamingQuery:
    """Run the feed into ``change_log``. ``trigger`` defaults to everything available, then stop.

    ``tables`` is called once per micro-batch, so each batch reads the tables as they are then. With ``positions``
    each batch, once its changes are written, notes in that folder how far ``group`` has come.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        changes = cdc.change_set(decode_events(batch), tables(), moment(now()), strict)
        changes.write.mode("overwrite").parquet(f"{change_log}/batch_id={batch_id}")
        if positions:
            reached = batch.groupBy(F.col("partition").alias("partition_id")).agg(
                F.lit(group).alias("group_name"), (F.max("offset") + 1).alias("committed_offset")
            )
            reached.write.mode("overwrite").parquet(f"{positions}/batch_id={batch_id}")

    writer = messages.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_positions(spark: SparkSession, positions: str) -> DataFrame:
    """The offsets table of a running feed: each partition's furthest position per group."""
    rows = spark.read.schema(f"{GROUP_OFFSET}, batch_id bigint").parquet(positions)
    return rows.groupBy("group_name", "partition_id").agg(F.max("committed_offset").alias("committed_offset"))


def pull(
    store: IndexStore,
    read: Callable[[Positions, Positions], DataFrame],
    latest: Callable[[], Positions],
    apply: Callable[[DataFrame, Positions], None],
    limit: int,
    idle_after: float = 5.0,
    poll: float = 0.5,
    clock: Callable[[], float] = time.monotonic,
    sleep: Callable[[float], None] = time.sleep,
) -> int:
    """Pulls from the positions in the store's commit on, at most ``limit`` messages a batch, until nothing has come for ``idle_after`` seconds.

    ``latest`` gives the topic's ends, ``read(start, end)`` the messages of a range, and ``apply(messages, end)`` commits
    what they change together with ``end``. Returns the number of batches.
    """
    batches, since = 0, clock()
    while clock() - since < idle_after:
        start = {int(partition): place for partition, place in store.latest().positions.items()}
        step = next_positions(start, latest(), limit)
        if step == start:
            sleep(poll)
            continue
        apply(read(start, step), step)
        batches, since = batches + 1, clock()
    return batches


def read_change_log(spark: SparkSession, change_log: str) -> DataFrame:
    """All logged changes; none for a log that has no batch yet."""
    columns = f"{TABLES['spent_detail_indexing']}, event_at timestamp_ntz, op string, batch_id bigint"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(change_log)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).parquet(change_log)


def read_index(index: DataFrame, change_log: DataFrame, by_event_time: bool = False) -> DataFrame:
    """The index with all logged changes.

    Per key the latest batch counts, whatever its event times, as each batch stands
    alone. With ``by_event_time`` a stale event in a later batch does not.
    """
    return cdc.merge_change_set(index, cdc.newest_change_per_key(change_log, by_event_time))


def last_batch(change_log: DataFrame) -> int:
    """Number of the newest batch in the log, -1 without one."""
    return change_log.agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]


def compact(store: IndexStore, change_log: DataFrame, now: datetime, by_event_time: bool = False) -> Commit:
    """Folds the batches after the last folded one into the table: one commit, of only the files they touch.

    The feed may go on meanwhile, on the same log, and so may a rebuild: where another commit comes first,
    the batches after that one's last are folded instead.
    """
    while True:
        base = store.latest()
        later = change_log.filter(F.col("batch_id") > base.last_batch)
        last = last_batch(later)
        if last < 0:
            return base
        changes = cdc.newest_change_per_key(later.filter(F.col("batch_id") <= last), by_event_time)
        try:
            return store.apply(changes, now, last_batch=last, base=base, by_event_time=by_event_time)
        except CommitConflict:
            continue


def read_current(store: IndexStore, change_log: DataFrame, by_event_time: bool = False) -> DataFrame:
    """The committed table with the batches that came after those folded into it."""
    commit = store.latest()
    return read_index(store.read(commit), change_log.filter(F.col("batch_id") > commit.last_batch), by_event_time)


def trim_change_log(store: IndexStore, spark: SparkSession, change_log: str) -> list[str]:
    """Drops the batches that are in every commit the store still keeps; returns their folders."""
    kept = min(store.commit(version).last_batch for version in store.versions())
    folder = SharedFolder(spark, change_log)
    batches = [name for name in folder.names() if name.startswith("batch_id=")]
    dropped = [name for name in batches if int(name.removeprefix("batch_id=")) <= kept]
    for name in dropped:
        folder.delete(name)
    return dropped


def land_messages(messages: DataFrame, path: str, files: int | None = None) -> None:
    """Store messages as JSON files that ``read_feed_files`` can stream."""
    (messages.repartition(files) if files else messages).write.mode("append").json(path)


def copy_stream(messages: DataFrame, path: str, checkpoint: str) -> None:
    """Pull everything available from a message stream into parquet files."""
    query = (
        messages.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
