"""Feed positions: from the offsets table to bounded reads of a topic, and back.

Positions are the next offset to read, by partition. There is one for each partition of a topic, a bounded few, so
they are plain dictionaries on the driver.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kafka's word for the first offset that a partition still has.
EARLIEST = -2

Positions = dict[int, int]


def positions_of(offsets: DataFrame, group: str) -> dict[int, int]:
    """The committed positions of a group."""
    rows = offsets.filter(F.col("group_name") == group).groupBy("partition_id").agg(F.max("committed_offset").alias("at"))
    return {row.partition_id: row["at"] for row in rows.collect()}


def with_positions(offsets: DataFrame, group: str, positions: Mapping[int, int]) -> DataFrame:
    """The offsets table after the group committed ``positions``; its other partitions stay where they are."""
    schema = offsets.select("group_name", "partition_id", "committed_offset").schema
    rows = [(group, partition, place) for partition, place in positions.items()]
    moved = offsets.sparkSession.createDataFrame(rows, schema)
    stay = offsets.filter((F.col("group_name") != group) | ~F.col("partition_id").isin(list(positions)))
    return stay.select(schema.names).unionByName(moved)


def kafka_offsets(topic: str, positions: Mapping[int, int], partitions: Mapping[int, int] | None = None) -> str:
    """Positions as Kafka's JSON. All ``partitions`` of a read must be in it; those without a position start at the first offset."""
    places = {str(p): positions.get(p, EARLIEST) for p in sorted({*positions, *(partitions or {})})}
    return json.dumps({topic: places})


def in_range(start: Mapping[int, int], end: Mapping[int, int]) -> Column:
    """Whether a message (partition, offset) lies from ``start`` on and before ``end``.

    A partition without a start is read from its first offset, one without an end not at all.
    """
    inside = F.lit(False)
    for partition, stop in sorted(end.items()):
        here = (F.col("partition") == partition) & (F.col("offset") < stop)
        inside = inside | (here & (F.col("offset") >= start.get(partition, 0)))
    return inside


def next_positions(start: Mapping[int, int], end: Mapping[int, int], limit: int) -> dict[int, int]:
    """Positions after a read of at most ``limit`` messages towards ``end``, each partition in proportion to what it has.

    Positions never go back, and every read makes headway where there is something left.
    """
    left = {p: max(0, stop - start.get(p, 0)) for p, stop in end.items()}
    total = sum(left.values())
    moved = dict(start)
    if not total:
        return moved
    room = min(limit, total)
    if room < 1:
        raise ValueError("a read needs room for one message")
    taken = {p: n * room // total for p, n in left.items()}
    for partition in sorted(left, key=lambda p: (taken[p] - left[p] * room / total, p)):  # those cut short most, first
        if sum(taken.values()) < room and taken[partition] < left[partition]:
            taken[partition] += 1
    for partition, n in taken.items():
        if n:
            moved[partition] = start.get(partition, 0) + n
    return moved
