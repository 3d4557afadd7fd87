from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendlake.operators.limits import needed_rows

KINDS = {
    "bigint": lambda dice: dice.choice([None, -(2**62), 2**62, *range(-50, 50)]),
    "int": lambda dice: dice.randint(0, 3),
    "decimal(12,3)": lambda dice: dice.choice([None, Decimal(dice.randint(-9999, 9999)) / 1000]),
    "double": lambda dice: dice.choice([None, dice.uniform(-1, 1), 1e300, -1e300, 0.5]),
    "string": lambda dice: dice.choice([None, "", "a", "éclair", f"same prefix {dice.randint(0, 99)}", f"w{dice.randint(0, 99)}"]),
    "timestamp_ntz": lambda dice: datetime(2024, 3, 10) + timedelta(microseconds=dice.randint(0, 10**11)),
    "date": lambda dice: (datetime(1960, 1, 1) + timedelta(days=dice.randint(0, 20_000))).date(),
}


def first_rows(rows, ascending, limit):
    """Python's answer: NULL first in ascending order, last in descending; then by id."""
    found = set()
    for group in {g for g, _, _ in rows}:
        own = [(v, i) for g, v, i in rows if g == group]
        own.sort(key=lambda r: r[1])
        if ascending:
            own.sort(key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0) if r[0] is not None else (False,))
        else:
            held = sorted((r for r in own if r[0] is not None), key=lambda r: r[0], reverse=True)
            own = held + [r for r in own if r[0] is None]
        found |= {i for _, i in own[:limit]}
    return found


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("ascending", [True, False])
def test_no_row_of_the_first_is_dropped(spark, kind, ascending):
    dice = random.Random(kind)
    rows = [(dice.choice([None, 1, 2, 2, 2, 2]), KINDS[kind](dice), i) for i in range(1500)]
    frame = spark.createDataFrame(rows, f"g int, v {kind}, id bigint")
    left = {r.id for r in needed_rows(frame, "g", [("v", ascending), ("id", True)], 20).collect()}
    assert first_rows(rows, ascending, 20) <= left


def test_little_more_than_the_limit_is_left(spark):
    frame = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).cast("int").alias("g"),
        (F.xxhash64("id") % 10_000_000).alias("v"),
        "id",
    )
    left = needed_rows(frame, "g", [("v", False), ("id", True)], 100).groupBy("g").count().collect()
    assert all(100 <= row["count"] <= 220 for row in left) and len(left) == 50


def test_one_value_that_all_share_is_told_apart_by_the_id(spark):
    frame = spark.range(100_000).select(F.lit(1).alias("g"), F.lit(7).alias("v"), (99_999 - F.col("id")).alias("id"))
    left = [r.id for r in needed_rows(frame, "g", [("v", False), ("id", True)], 50).collect()]
    assert set(range(50)) <= set(left) and len(left) <= 150


def test_groups_within_the_limit_stay_whole(spark):
    frame = spark.createDataFrame([(1, 5, 1), (1, 6, 2), (None, 1, 3)], "g int, v int, id bigint")
    assert needed_rows(frame, "g", [("v", True), ("id", True)], 2).count() == 3
    assert needed_rows(frame.limit(0), "g", [("v", True), ("id", True)], 2).count() == 0


def test_an_unknown_kind_of_order_is_an_error(spark):
    with pytest.raises(TypeError, match="order"):
        needed_rows(spark.range(3).select(F.array("id").alias("v"), "id", F.lit(1).alias("g")), "g", [("v", True)], 1)
