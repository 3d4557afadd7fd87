"""Newest event per key across micro-batches, kept as state of the stream.

Each micro-batch of a feed stands alone, so an event that arrives late could undo a newer one of an earlier
batch. The guard remembers each key's newest event time and lets only later events through. A key that has
been silent for the given time is forgotten, which bounds the state; an event older than that is dropped by the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The state store that keeps state on disk, a change log in the checkpoint.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Neighbouring keys that are handled in one call. A block holds at most so many, whatever the keys are.
BLOCK = 64

_COLUMNS = "spent_idx long, partition_id int, msg_offset long, indexing_type string, at long"


class _NewestEvent(StatefulProcessor):
    """Passes each key's newest event of each batch, if it is newer than all before; forgets silent keys.

    A call gets the rows of a block of keys: calls and requests to the state cost far more than rows.
    The state still has a newest time for each key, in microseconds, by the key's ``slot`` in its block.
    """

    def __init__(self, forget_after_ms: int) -> None:
        self.forget_after_ms = forget_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getMapState("newest", "slot int", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        best = None
        for frame in rows:  # one batch of a block's rows after the other; only one row of each key is held
            best = _newest(frame if best is None else pd.concat([best, frame]))
        if best is None:
            return
        known = self._known()
        passed = best[[slot not in known or known[slot] < at for slot, at in zip(best["slot"], best["at"])]]
        if passed.empty:
            return
        for slot, at in zip(passed["slot"].tolist(), passed["at"].tolist()):
            self.newest.updateValue((slot,), (at,))
        self._wake_at(min(passed["at"].tolist()))
        yield passed[["spent_idx", "partition_id", "msg_offset", "indexing_type", "at"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        over = timerValues.getCurrentWatermarkInMs()
        known = self._known()
        kept = [at for at in known.values() if self._expiry(at) > over]
        for slot, at in known.items():
            if self._expiry(at) <= over:
                self.newest.removeKey((slot,))
        if kept:
            self._wake_at(min(kept))
        yield from ()

    def close(self) -> None:
        pass

    def _known(self) -> dict[int, int]:
        return {slot: at for (slot,), (at,) in self.newest.iterator()}

    def _expiry(self, at: int) -> int:
        return at // 1000 + self.forget_after_ms

    def _wake_at(self, at: int) -> None:
        """A block has one timer, no later than its first key expires; where it comes early, nothing is forgotten yet."""
        timers = list(self.handle.listTimers())
        if not timers or self._expiry(at) < min(timers):
            for timer in timers:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(self._expiry(at))


def _newest(rows: pd.DataFrame) -> pd.DataFrame:
    """Each slot's newest row, of those of one time the one with the smallest offset."""
    return rows.sort_values(["at", "msg_offset"], ascending=[False, True], kind="stable").drop_duplicates("slot")


def newest_events(events: DataFrame, forget_after: str = "7 days") -> DataFrame:
    """Of a stream of decoded ``events`` those that are newer than every earlier event of their key.

    At most one per key and micro-batch. Events that come later than ``forget_after`` behind the newest event of the
    stream are dropped, and so is the state of keys silent for as long.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    limit = int(pd.Timedelta(forget_after).total_seconds() * 1000)
    timed = events.withColumn("reg_at", F.col("reg_at").cast("timestamp"))
    timed = timed.withWatermark("reg_at", forget_after)
    slot = F.coalesce(F.pmod("spent_idx", F.lit(BLOCK)), F.lit(0)).cast("int").alias("slot")
    block = F.shiftright("spent_idx", BLOCK.bit_length() - 1).alias("block")
    kept = timed.select(
        "spent_idx", "partition_id", "msg_offset", "indexing_type", F.unix_micros("reg_at").alias("at"), "reg_at", slot, block
    )
    passed = kept.groupBy("block").transformWithStateInPandas(
        _NewestEvent(limit), outputStructType=_COLUMNS, outputMode="append", timeMode="EventTime"
    )
    at = F.timestamp_micros("at").cast("timestamp_ntz").alias("reg_at")
    return passed.select("spent_idx", "partition_id", "msg_offset", "indexing_type", at)
