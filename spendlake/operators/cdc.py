"""Change-feed operators: events to actions, actions to row changes, lag and offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.functions.changes import change_type
from spendlake.operators import merge
from spendlake.operators.denormalise import spends_for_index
from spendlake.session import stored


def latest_action(events: DataFrame) -> DataFrame:
    """Per key the newest event and what it asks for; among equal times the first one in the feed.

    ``max_by`` combines before the shuffle, so a key with most of the events costs
    one row per task. Only surviving events have their change type checked.
    """
    order = F.struct(F.col("reg_at"), -F.col("msg_offset"))
    latest = events.groupBy("spent_idx").agg(
        F.max_by(F.struct("indexing_type", "reg_at"), order).alias("event")
    )
    kind = change_type(F.col("event.indexing_type"))
    return latest.select(
        "spent_idx",
        kind.alias("indexing_type"),
        F.when(kind == "D", "delete").otherwise("upsert").alias("action"),
        F.col("event.reg_at").alias("reg_at"),
    )


def final_action(events: DataFrame) -> DataFrame:
    """The net effect of all events of a key, in time order.

    Folding the events one by one only ever remembers two facts: whether the key
    first appeared by an insert, and whether the last event was a delete. So the
    first and the last event suffice and no group of events is collected.
    """
    typed = events.withColumn("kind", change_type(F.col("indexing_type")))
    order = F.struct("reg_at", "msg_offset")
    ends = typed.groupBy("spent_idx").agg(
        F.min_by("kind", order).alias("first"), F.max_by("kind", order).alias("last")
    )
    born_here, gone = F.col("first") == "I", F.col("last") == "D"
    action = (
        F.when(born_here & gone, "noop").when(born_here, "upsert_new").when(gone, "delete").otherwise("upsert_existing")
    )
    return ends.select("spent_idx", action.alias("final_action"), (~gone).alias("is_upsert_required"))


def change_set(events: DataFrame, tables, now: Column, strict: bool = False) -> DataFrame:
    """Index rows to write (``op`` upsert) and keys to remove (``op`` delete), one row per key.

    ``event_at`` is the time of the event behind the change. An upserted key that no
    longer qualifies for the index is left alone, as the service does; ``strict``
    removes it. The actions are stored, so the events are read once.
    """
    actions = stored(latest_action(events).withColumnRenamed("reg_at", "event_at"), "actions")
    upserts = actions.filter(F.col("action") == "upsert")
    spends = spends_for_index(tables, upserts, carry=["event_at"])
    rows = merge.index_rows(spends, now).withColumn("op", F.lit("upsert"))
    keys = ["spent_idx", "event_at"]
    gone = actions.filter(F.col("action") == "delete").select(keys)
    if strict:
        gone = gone.unionByName(merge.without_keys(upserts.select(keys), rows, "spent_idx"))
    return rows.unionByName(gone.withColumn("op", F.lit("delete")), allowMissingColumns=True)


def merge_change_set(index: DataFrame, changes: DataFrame) -> DataFrame:
    kept = merge.without_keys(index, changes, "spent_idx")
    return kept.unionByName(changes.filter(F.col("op") == "upsert").select(index.columns))


def apply_changes(index: DataFrame, events: DataFrame, tables, now: Column, strict: bool = False) -> DataFrame:
    """The index after the events: the newest event of each key is carried out.

    The change set is stored first. Its joins so run once, and while it is small its
    keys are broadcast, so that the index is not shuffled.
    """
    return merge_change_set(index, stored(change_set(events, tables, now, strict), "changes"))


def newest_change_per_key(change_log: DataFrame, by_event_time: bool = False) -> DataFrame:
    """Of all logged change sets each key's row from the latest batch, or with the latest event."""
    order = F.struct("event_at", "batch_id") if by_event_time else F.struct("batch_id")
    ordered = change_log.withColumn("order", order)
    return merge.last_per_key(ordered, "spent_idx", "order").drop("order", "batch_id")


def events_after(events: DataFrame, offsets: DataFrame, group: str) -> DataFrame:
    """Events at or past the group's committed position; a partition without one is read from its start.

    The positions, one per topic partition, are one map value: the events are not shuffled.
    """
    entry = F.struct("partition_id", "committed_offset")
    positions = (
        offsets.filter(F.col("group_name") == group).agg(F.map_from_entries(F.collect_list(entry))).scalar()
    )
    position = F.coalesce(F.try_element_at(positions, F.col("partition_id")), F.lit(0))
    return events.filter(F.col("msg_offset") >= position)


def lag_by_partition(offsets: DataFrame, reference: str, catchup: str) -> DataFrame:
    """Both groups' positions side by side, 0 where a group has none, and how far catch-up is behind."""
    position = lambda group: F.coalesce(
        F.max(F.when(F.col("group_name") == group, F.col("committed_offset"))), F.lit(0)
    )
    paired = (
        offsets.filter(F.col("group_name").isin(reference, catchup))
        .groupBy("partition_id")
        .agg(position(reference).alias("reference_offset"), position(catchup).alias("catchup_offset"))
    )
    lag = F.greatest(F.col("reference_offset") - F.col("catchup_offset"), F.lit(0))
    return paired.withColumn("lag", lag)


def total_lag(offsets: DataFrame, reference: str, catchup: str) -> DataFrame:
    """Sum of the partition lags, and the older figure: difference of the totals, not below 0."""
    lags = lag_by_partition(offsets, reference, catchup)
    behind = F.coalesce(F.sum("reference_offset") - F.sum("catchup_offset"), F.lit(0))
    return lags.agg(
        F.coalesce(F.sum("lag"), F.lit(0)).alias("total_lag"),
        F.greatest(behind, F.lit(0)).alias("lag_of_totals"),
    )


def copy_offsets(offsets: DataFrame, source: str, target: str) -> DataFrame:
    """The target group takes over the source group's positions; with no source positions nothing changes."""
    copied = offsets.filter(F.col("group_name") == source).withColumn("group_name", F.lit(target))
    replaced = offsets.filter(F.col("group_name") == target).join(copied, "partition_id", "left_anti")
    others = offsets.filter(F.col("group_name") != target)
    return others.unionByName(replaced.select(offsets.columns)).unionByName(copied)
