from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from spendlake.operators import offsets
from spendlake.operators.store import CommitConflict, IndexStore
from spendlake.plans import spend

NOW, LATER = datetime(2024, 2, 1), datetime(2024, 2, 5)
CHANGES = "key long, day int, text string, event_at timestamp_ntz, op string"


@pytest.fixture
def store(spark, tmp_path):
    return IndexStore(spark, str(tmp_path / "store"), "key", ["day"], rows_per_file=100)


def table(spark, n=1000):
    return spark.range(n).select(F.col("id").alias("key"), (F.col("id") / 50).cast("int").alias("day"), F.lit("old").alias("text"))


def changes(spark, *listed):
    made = [(k, d, t, None if at is None else datetime(2024, 1, 1) + timedelta(hours=at), op) for k, d, t, at, op in listed]
    return spark.createDataFrame(made, CHANGES)


def paths(store):
    return {row.path for row in store.files(store.latest()).collect()}


def listed(store, version):
    return {row.path for row in store.files(store.commit(version)).collect()}


def test_ten_changed_keys_leave_all_other_files(spark, store):
    store.publish(table(spark), NOW, size=1000)
    before = paths(store)
    keyed = {row.path: (row.key_min, row.key_max) for row in store.files(store.latest()).collect()}
    assert len(before) > 3
    low, high = min(keyed.values())
    assert high - low > 20
    listed = [(low + i, 0, "new", 1, "upsert" if i % 2 else "delete") for i in range(10)]
    store.apply(changes(spark, *listed), NOW)
    after = paths(store)
    assert len(before - after) == 1 and before & after == before - {p for p, r in keyed.items() if r == (low, high)}
    found = {row.key: row.text for row in store.read().collect()}
    assert len(found) == 995 and {k for k, t in found.items() if t == "new"} == {low + i for i in range(1, 10, 2)}


def test_changes_of_new_keys_touch_no_file(spark, store):
    store.publish(table(spark), NOW)
    before = paths(store)
    store.apply(changes(spark, (5000, 1, "new", 1, "upsert"), (6000, 1, None, 1, "delete")), NOW)
    assert before < paths(store) and store.read().count() == 1001


def test_stale_events_do_nothing_deletes_included(spark, store):
    store.publish(table(spark, 10), NOW)
    store.apply(changes(spark, (1, 0, "new", 5, "upsert"), (2, None, None, 5, "delete")), NOW)
    store.apply(changes(spark, (1, 0, "stale", 4, "upsert"), (2, 0, "stale", 5, "upsert"), (3, None, None, 1, "delete")), NOW)
    found = dict(rows(store.read(), "key", "text"))
    assert found[1] == "new" and 2 not in found and 3 not in found and len(found) == 8
    store.apply(changes(spark, (2, 0, "again", 6, "upsert"), (1, 0, "older", 1, "upsert")), NOW, by_event_time=False)
    found = dict(rows(store.read(), "key", "text"))
    assert (found[1], found[2]) == ("older", "again")


def test_random_changes_equal_a_dictionary(spark, store):
    chance = random.Random(3)
    store.publish(table(spark, 300), NOW)
    wanted = {k: "old" for k in range(300)}
    seen = {}
    for turn in range(4):
        listed = []
        for key in chance.sample(range(400), 40):
            at, op = chance.randint(0, 50), chance.choice(["upsert", "delete"])
            listed.append((key, key // 50, f"t{turn}", at, op))
            if key not in seen or at > seen[key]:
                seen[key] = at
                wanted.pop(key, None)
                if op == "upsert":
                    wanted[key] = f"t{turn}"
        store.apply(changes(spark, *listed), NOW)
        assert dict(rows(store.read(), "key", "text")) == wanted
        assert store.files(store.latest()).agg(F.sum("rows")).first()[0] >= len(wanted)


def test_no_changes_move_the_commit_on(spark, store):
    first = store.publish(table(spark, 5), NOW, last_batch=3, positions={0: 7})
    moved = store.apply(changes(spark), NOW, positions={0: 9})
    assert (moved.version, moved.last_batch, moved.positions) == (first.version + 1, 3, {"0": 9})
    assert store.read().count() == 5


def test_an_empty_table_takes_changes(spark, store):
    store.publish(table(spark, 0), NOW)
    assert store.read().collect() == []
    store.apply(changes(spark, (1, 0, "new", 1, "upsert")), NOW)
    assert rows(store.read()) == [(1, 0, "new")]


def test_of_two_writers_one_comes_first(spark, store):
    base = store.publish(table(spark, 10), NOW)
    store.apply(changes(spark, (1, 0, "first", 1, "upsert")), NOW, base=base)
    with pytest.raises(CommitConflict):
        store.apply(changes(spark, (2, 0, "second", 1, "upsert")), NOW, base=base)
    assert dict(rows(store.read(), "key", "text"))[2] == "old"
    assert set(store.folder.names("data")) == {p.split("/")[0] for v in store.versions() for p in listed(store, v)}
    store.publish(table(spark, 3), NOW)  # a whole table replaces whatever is there
    assert store.read().count() == 3 and store.versions() == [2, 3]


def test_reading_before_a_commit(spark, store):
    with pytest.raises(LookupError):
        store.read()
    with pytest.raises(LookupError):
        store.apply(changes(spark), NOW)


def test_a_killed_writer_leaves_nothing_after_the_grace_time(spark, store, tmp_path):
    store.publish(table(spark, 10), NOW)
    folder, _, _ = store._written(table(spark, 5).withColumns({"event_at": F.lit(None).cast("timestamp_ntz"), "is_gone": F.lit(False)}), None, NOW)
    store.apply(changes(spark, (1, 0, "new", 1, "upsert")), NOW + timedelta(hours=1))
    assert (tmp_path / "store/data" / folder).exists()  # perhaps it still goes on
    for hours in (2, 3):
        store.apply(changes(spark, (1, 0, "new", hours, "upsert")), LATER + timedelta(hours=hours))
    assert not (tmp_path / "store/data" / folder).exists() and not (tmp_path / "store/started" / folder).exists()
    kept = {p for version in store.versions() for p in (r.path for r in store.files(store.commit(version)).collect())}
    stored = {f"{p.parent.name}/{p.name}" for p in (tmp_path / "store/data").glob("*/part-*")}
    assert stored == kept and len(list((tmp_path / "store/manifests").iterdir())) == 2
    assert store.read().count() == 10


def test_positions_move_in_bounded_steps():
    start, end = {0: 5, 1: 0, 3: 4}, {0: 10, 1: 100, 2: 7}
    steps = []
    while (step := offsets.next_positions(start, end, 30)) != start:
        moved = sum(step.get(p, 0) - start.get(p, 0) for p in {*step, *start})
        assert 0 < moved <= 30 and all(step[p] >= start[p] for p in start)
        steps, start = [*steps, moved], step
    assert start == {0: 10, 1: 100, 2: 7, 3: 4} and steps == [30, 30, 30, 22]
    assert offsets.next_positions({0: 9}, {0: 5}, 10) == {0: 9}
    with pytest.raises(ValueError, match="room"):
        offsets.next_positions({}, {0: 5}, 0)


def test_positions_as_kafka_writes_them():
    assert offsets.kafka_offsets("t", {1: 5}, {0: 9, 1: 9}) == '{"t": {"0": -2, "1": 5}}'


def test_offsets_table_there_and_back(spark):
    listed = [("own", 0, 5), ("own", 1, 6), ("ref", 0, 8)]
    frame = spark.createDataFrame(listed, "group_name string, partition_id int, committed_offset bigint")
    assert offsets.positions_of(frame, "own") == {0: 5, 1: 6} and offsets.positions_of(frame, "none") == {}
    moved = offsets.with_positions(frame, "own", {0: 7, 2: 1})
    assert rows(moved) == [("own", 0, 7), ("own", 1, 6), ("own", 2, 1), ("ref", 0, 8)]
    messages = spark.createDataFrame([(p, o) for p in range(3) for o in range(4)], "partition int, offset bigint")
    assert rows(messages.filter(offsets.in_range({0: 2}, {0: 4, 1: 1}))) == [(0, 2), (0, 3), (1, 0)]
    assert rows(messages.filter(offsets.in_range({}, {}))) == []


def test_a_failed_step_is_read_again_from_its_place(spark, store, monkeypatch):
    store.publish(table(spark, 10), NOW, positions={0: 0})
    reads = []

    def read(start, end):
        reads.append((dict(start), dict(end)))
        if len(reads) == 2:
            raise ConnectionError("gone")
        return spark.range(1)

    def change_set(events, *_):
        n = len(reads)
        return changes(spark, (n, 0, f"step {n}", n, "upsert"))

    monkeypatch.setattr(spend.cdc, "change_set", change_set)
    monkeypatch.setattr(spend, "decode_events", lambda messages: messages)
    with pytest.raises(ConnectionError):
        spend.catch_up(store, read, None, {0: 5}, 2, NOW)
    assert store.latest().positions == {"0": 2}
    spend.catch_up(store, read, None, {0: 5}, 2, NOW)
    assert [r[0][0] for r in reads] == [0, 2, 2, 4] and store.latest().positions == {"0": 5}
    assert {t for t in dict(rows(store.read(), "key", "text")).values() if t != "old"} == {"step 1", "step 3", "step 4"}
