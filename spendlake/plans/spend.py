"""Spend jobs: full index, keyword index, reclassification, feed catch-up."""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spendlake.functions.dates import moment
from spendlake.operators import cdc
from spendlake.operators.classify import classify_names, reclassify
from spendlake.operators.denormalise import full_index, keywords_with_type
from spendlake.operators.offsets import next_positions, positions_of
from spendlake.operators.publish import VersionedTable
from spendlake.operators.search import SearchOptions
from spendlake.operators.store import Commit, CommitConflict, IndexStore
from spendlake.session import stored
from spendlake.sources.feed import decode_events
from spendlake.streaming.feed import last_batch


def publish_full_index(
    index: DataFrame, target: VersionedTable, now: datetime, schema: StructType | None = None
) -> DataFrame:
    """Publish the whole index as a new version, files sorted by time for the reports, and read it back."""
    target.publish(index, now, schema, sort_by=["spent_at"])
    return target.read()


def publish_keywords(tables, target: VersionedTable, now: datetime) -> DataFrame:
    """Publish keywords with their category as a new version and read it back."""
    target.publish(keywords_with_type(tables.prodt_keyword, tables.keyword_type), now)
    return target.read()


def reclassify_spends(
    spends: DataFrame,
    keywords: DataFrame,
    with_type_name: bool = False,
    options: SearchOptions = SearchOptions(),
    synonyms: DataFrame | None = None,
) -> DataFrame:
    """Every spend with the category of its name. Each distinct name is classified once.

    The spends are read twice: for their names, which are stored, and for the result.
    """
    names = stored(spends.groupBy("spent_name").agg(F.count(F.lit(1)).alias("rows")), "names")
    verdicts = classify_names(names.select("spent_name"), keywords, options, synonyms)
    return reclassify(spends, verdicts, names, with_type_name)


def backfill_and_catch_up(
    tables, events: DataFrame, offsets: DataFrame, group: str, now: datetime | str, strict: bool = False
) -> DataFrame:
    """A fresh full index plus every event past the recorded position of ``group``."""
    unread = cdc.events_after(events, offsets, group)
    return cdc.apply_changes(full_index(tables), unread, tables, moment(now), strict)


def rebuild_index(
    tables,
    events: DataFrame,
    offsets: DataFrame,
    own_group: str,
    incremental_group: str,
    store: IndexStore,
    now: datetime,
    change_log: DataFrame | None = None,
) -> DataFrame:
    """A fresh index from the tables and the events since the incremental group's position, committed in one step.

    Position and last batch of the ``change_log`` are taken before the load, so no event is missed; those
    already in the load are applied again, which changes nothing. The feed goes on meanwhile: its batches are later than
    the one that the commit notes, so ``read_current`` lays them over the new index.
    """
    folded = last_batch(change_log) if change_log is not None else -1
    marked = cdc.copy_offsets(offsets, incremental_group, own_group)
    rebuilt = backfill_and_catch_up(tables, events, marked, own_group, now)
    store.publish(rebuilt, now, last_batch=folded, positions=positions_of(marked, own_group))
    return store.read()


def catch_up(
    store: IndexStore,
    read: Callable[[dict[int, int], dict[int, int]], DataFrame],
    tables,
    end: dict[int, int],
    limit: int,
    now: datetime,
    strict: bool = False,
) -> Commit:
    """Brings the store's table from the positions in its commit to ``end``, at most ``limit`` messages at a time.

    ``read(start, end)`` gives the messages of that range. Each step's changes and new positions are one commit, so a
    step that failed is read again from the same place, and none is applied twice.
    """
    while True:
        base = store.latest()
        start = {int(partition): place for partition, place in base.positions.items()}
        step = next_positions(start, end, limit)
        if step == start:
            return base
        changes = cdc.change_set(decode_events(read(start, step)), tables, moment(now), strict)
        with contextlib.suppress(CommitConflict):  # then from where the other writer is
            store.apply(changes, now, positions=step, base=base)
