from __future__ import annotations

from datetime import datetime
from types import SimpleNamespace

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from spendlake.functions.dates import moment
from spendlake.operators import cdc
from spendlake.operators.denormalise import full_index
from spendlake.operators.store import IndexStore
from spendlake.plans import spend
from spendlake.sources import feed
from spendlake.streaming import feed as stream
from spendlake.streaming import guard

NOW = datetime(2024, 2, 1)


def at(minute):
    return datetime(2024, 1, 1, 0, minute)


def events(spark, *items):
    """``(spent_idx, type, minute)`` in feed order."""
    data = [(0, offset, key, kind, at(minute)) for offset, (key, kind, minute) in enumerate(items)]
    return spark.createDataFrame(
        data, "partition_id int, msg_offset bigint, spent_idx bigint, indexing_type string, reg_at timestamp_ntz"
    )


def actions(frame):
    return dict(rows(cdc.latest_action(frame), "spent_idx", "action"))


def test_on_equal_times_the_first_event_stays(spark):
    assert actions(events(spark, (1, "I", 5), (1, "D", 5))) == {1: "upsert"}


def test_a_stale_delete_loses(spark):
    assert actions(events(spark, (1, "I", 5), (1, "D", 4))) == {1: "upsert"}


def test_spellings_in_any_case(spark):
    frame = events(spark, (1, "insert", 1), (2, "Update", 1), (3, "delete", 1), (4, "d", 1))
    assert actions(frame) == {1: "upsert", 2: "upsert", 3: "delete", 4: "delete"}


def test_unknown_type_matters_only_when_it_wins(spark):
    assert actions(events(spark, (1, "X", 1), (1, "I", 2))) == {1: "upsert"}
    with pytest.raises(Exception, match="unknown change type"):
        actions(events(spark, (1, "I", 1), (1, "X", 2)))


@pytest.mark.parametrize(
    ("kinds", "wanted"),
    [
        ("I", "upsert_new"), ("U", "upsert_existing"), ("D", "delete"), ("ID", "noop"), ("IDI", "upsert_new"),
        ("IDU", "upsert_new"), ("UD", "delete"), ("DI", "upsert_existing"), ("DU", "upsert_existing"),
        ("DD", "delete"), ("IDD", "noop"), ("UDI", "upsert_existing"), ("IUDUD", "noop"), ("DID", "delete"),
    ],
)
def test_final_action(spark, kinds, wanted):
    frame = events(spark, *[(1, kind, place) for place, kind in enumerate(kinds)])
    assert rows(cdc.final_action(frame), "final_action", "is_upsert_required") == [
        (wanted, wanted.startswith("upsert"))
    ]


def spend_tables(spark, spends):
    """``(spent_idx, room, should_index)``; room 1 is approved and active, 2 unapproved, 3 in an inactive group."""
    spent_detail = spark.createDataFrame(
        [(key, f"name {key}", key * 100, at(0), at(0), indexed, 1, 1, room, 1) for key, room, indexed in spends],
        "spent_idx bigint, spent_name string, spent_money bigint, spent_at timestamp_ntz, created_at timestamp_ntz, "
        "should_index boolean, user_seq bigint, consume_keyword_type_id bigint, room_seq bigint, "
        "payment_method_id bigint",
    )
    return SimpleNamespace(
        spent_detail=spent_detail,
        keyword_type=spark.createDataFrame([(1, "food")], "consume_keyword_type_id bigint, consume_keyword_type string"),
        users=spark.createDataFrame([(1, "u1")], "user_seq bigint, user_id string"),
        telegram_room=spark.createDataFrame(
            [(1, True, 1), (2, False, 1), (3, True, 2)], "room_seq bigint, is_room_approved boolean, agg_group_seq bigint"
        ),
        user_payment_methods=spark.createDataFrame([(1, "card")], "payment_method_id bigint, card_alias string"),
        agg_group=spark.createDataFrame([(1, True), (2, False)], "agg_group_seq bigint, is_active boolean"),
    )


def keys(frame):
    return [key for (key,) in rows(frame, "spent_idx")]


def test_index_takes_only_indexable_spends_of_approved_active_rooms(spark):
    tables = spend_tables(spark, [(1, 1, True), (2, 1, False), (3, 2, True), (4, 3, True)])
    assert keys(full_index(tables)) == [1]


def test_a_row_that_stops_qualifying_stays_unless_strict(spark):
    index = full_index(spend_tables(spark, [(1, 1, True), (2, 1, True)]))
    now_hidden = spend_tables(spark, [(1, 1, False), (2, 1, True)])
    frame = events(spark, (1, "U", 1), (2, "U", 1))
    assert keys(cdc.apply_changes(index, frame, now_hidden, moment(NOW))) == [1, 2]
    assert keys(cdc.apply_changes(index, frame, now_hidden, moment(NOW), strict=True)) == [2]


def test_deletes_and_inserts_are_applied(spark):
    tables = spend_tables(spark, [(1, 1, True), (2, 1, True), (5, 1, True)])
    index = full_index(tables).filter("spent_idx <> 5")
    frame = events(spark, (1, "D", 1), (5, "I", 1), (77, "D", 1))
    result = cdc.apply_changes(index, frame, tables, moment(NOW))
    assert rows(result, "spent_idx", "updated_by") == [(2, None), (5, "batch")]


def test_a_stale_delete_in_a_later_batch_still_deletes(spark, tmp_path):
    tables = spend_tables(spark, [(1, 1, True), (2, 1, True)])
    landed, log = str(tmp_path / "landed"), str(tmp_path / "log")
    for batch in (events(spark, (1, "U", 9), (2, "D", 3)), events(spark, (1, "D", 5), (2, "I", 7))):
        stream.land_messages(feed.event_messages(batch.coalesce(1)), landed)
        messages = feed.read_feed_files(spark, landed)
        stream.start_feed(messages, lambda: tables, log, str(tmp_path / "checkpoint"), now=lambda: NOW).awaitTermination()
    changes = stream.read_change_log(spark, log)
    assert changes.select("batch_id").distinct().count() == 2
    assert keys(stream.read_index(full_index(tables), changes)) == [2]
    # The guard keeps 1: its delete is older than its update.
    assert keys(stream.read_index(full_index(tables), changes, by_event_time=True)) == [1, 2]


def test_compaction_commits_the_merged_index(spark, tmp_path):
    tables = spend_tables(spark, [(1, 1, True), (2, 1, True)])
    store = IndexStore(spark, str(tmp_path / "index"), "spent_idx", ["spent_at"])
    store.publish(full_index(tables), datetime(2024, 1, 1))
    log = str(tmp_path / "log")
    cdc.change_set(events(spark, (1, "D", 1)), tables, moment(NOW)).write.parquet(f"{log}/batch_id=0")
    assert stream.compact(store, stream.read_change_log(spark, log), NOW).last_batch == 0
    assert keys(store.read()) == [2]


def test_decode_fails_on_a_bad_record_and_quarantine_keeps_it(spark):
    good = '{"spent_idx": 1, "indexing_type": "I", "reg_at": "2024-01-01T09:00:00+09:00"}'
    messages = spark.createDataFrame(
        [("1", good, 0, 0), ("2", '{"spent_idx": "x', 0, 1)], "key string, value string, partition int, offset bigint"
    )
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        feed.decode_events(messages).collect()
    decoded, bad = feed.decode_events_with_quarantine(messages)
    assert rows(decoded, "spent_idx", "reg_at") == [(1, datetime(2024, 1, 1))]
    assert rows(bad, "key") == [("2",)]


@pytest.mark.parametrize("value", ["{}", '{"spent_idx": 1}', '{"spent_idx": 1, "indexing_type": "I"}', None])
def test_messages_without_a_field_are_bad(spark, value):
    messages = spark.createDataFrame([("1", value, 0, 0)], "key string, value string, partition int, offset bigint")
    with pytest.raises(Exception, match="event without"):
        feed.decode_events(messages).collect()
    decoded, bad = feed.decode_events_with_quarantine(messages)
    assert decoded.count() == 0 and rows(bad, "key") == [("1",)]


def test_a_log_without_batches_is_empty(spark, tmp_path):
    assert stream.read_change_log(spark, str(tmp_path / "none")).count() == 0


def test_batches_that_land_during_compaction_stay(spark, tmp_path):
    tables = spend_tables(spark, [(1, 1, True), (2, 1, True), (3, 1, True)])
    store = IndexStore(spark, str(tmp_path / "index"), "spent_idx", ["spent_at"])
    store.publish(full_index(tables), datetime(2024, 1, 1))
    log = str(tmp_path / "log")
    cdc.change_set(events(spark, (1, "D", 1)), tables, moment(NOW)).write.parquet(f"{log}/batch_id=0")
    before = stream.read_change_log(spark, log)
    cdc.change_set(events(spark, (2, "D", 2)), tables, moment(NOW)).write.parquet(f"{log}/batch_id=1")
    assert stream.compact(store, before, NOW).last_batch == 0
    assert keys(stream.read_current(store, stream.read_change_log(spark, log))) == [3]
    # A batch that two commits hold goes; one that only the log holds stays.
    stream.compact(store, stream.read_change_log(spark, log), NOW)
    assert stream.trim_change_log(store, spark, log) == ["batch_id=0"]
    assert keys(stream.read_current(store, stream.read_change_log(spark, log))) == [3]


def test_events_are_decoded_before_catch_up(spark):
    frame = feed.decode_events(feed.event_messages(events(spark, (1, "D", 1), (2, "D", 2))))
    offsets = spark.createDataFrame([("own", 0, 2)], OFFSETS)
    assert keys(cdc.events_after(frame, offsets, "own")) in ([2], [])


OFFSETS = "group_name string, partition_id int, committed_offset bigint"


def test_lag_counts_partitions_of_either_side_and_never_goes_below_zero(spark):
    offsets = spark.createDataFrame(
        [("own", 0, 5), ("own", 2, 9), ("ref", 0, 8), ("ref", 1, 4), ("ref", 2, 7), ("other", 0, 99)], OFFSETS
    )
    assert rows(cdc.lag_by_partition(offsets, "ref", "own")) == [(0, 8, 5, 3), (1, 4, 0, 4), (2, 7, 9, 0)]
    assert rows(cdc.total_lag(offsets, "ref", "own")) == [(7, 5)]


def test_copying_offsets_from_a_group_without_any_changes_nothing(spark):
    offsets = spark.createDataFrame([("own", 0, 5)], OFFSETS)
    assert rows(cdc.copy_offsets(offsets, "ref", "own")) == [("own", 0, 5)]
    offsets = spark.createDataFrame([("own", 0, 5), ("own", 1, 6), ("ref", 0, 8)], OFFSETS)
    assert rows(cdc.copy_offsets(offsets, "ref", "own")) == [("own", 0, 8), ("own", 1, 6), ("ref", 0, 8)]


def test_a_rebuild_replays_what_came_after_the_incremental_position(spark, tmp_path):
    tables = spend_tables(spark, [(1, 1, True), (2, 1, True), (3, 1, True)])
    frame = events(spark, (1, "D", 1), (2, "D", 2), (3, "U", 3))
    offsets = spark.createDataFrame([("incremental", 0, 1), ("own", 0, 0)], OFFSETS)
    store = IndexStore(spark, str(tmp_path), "spent_idx", ["spent_at"])
    rebuilt = spend.rebuild_index(tables, frame, offsets, "own", "incremental", store, NOW)
    # The delete of 1 was consumed before; the full load has the row as the tables have it.
    assert rows(rebuilt, "spent_idx", "updated_by") == [(1, None), (3, "batch")]
    assert store.latest().positions == {"0": 1}


def test_a_batch_that_lands_during_a_rebuild_is_not_lost(spark, tmp_path):
    tables = spend_tables(spark, [(1, 1, True), (2, 1, True), (3, 1, True)])
    store = IndexStore(spark, str(tmp_path / "index"), "spent_idx", ["spent_at"])
    store.publish(full_index(tables), datetime(2024, 1, 1))
    log = str(tmp_path / "log")

    def land(batch, *changes):
        made = cdc.change_set(events(spark, *changes), tables, moment(NOW))
        made.write.parquet(f"{log}/batch_id={batch}")

    land(0, (1, "D", 1))
    publish = store.publish

    def late(*given, **named):  # a batch lands, and the feed's log is folded, just before the rebuild commits
        land(1, (2, "D", 2))
        stream.compact(store, stream.read_change_log(spark, log), NOW)
        return publish(*given, **named)

    store.publish = late
    offsets = spark.createDataFrame([("incremental", 0, 1), ("own", 0, 0)], OFFSETS)
    before = stream.read_change_log(spark, log)
    spend.rebuild_index(tables, events(spark, (1, "D", 1)), offsets, "own", "incremental", store, NOW, before)
    assert store.latest().last_batch == 0
    # The old change set 0 is not laid over the rebuilt rows; the later one is.
    assert keys(store.read()) == [1, 2, 3]
    assert keys(stream.read_current(store, stream.read_change_log(spark, log))) == [1, 3]


def test_partitions_without_a_position_are_read_from_the_start(spark):
    frame = spark.createDataFrame([(0, 4), (0, 5), (1, 0)], "partition_id int, msg_offset bigint")
    offsets = spark.createDataFrame([("own", 0, 5)], OFFSETS)
    assert rows(cdc.events_after(frame, offsets, "own")) == [(0, 5), (1, 0)]
    assert rows(cdc.events_after(frame, offsets, "nobody")) == [(0, 4), (0, 5), (1, 0)]


@pytest.mark.parametrize("moment_text", ["2024-03-10 02:30:00", "2024-11-03 05:30:00", "2024-11-03 06:30:00.000001"])
def test_event_times_survive_the_feed_in_any_session_zone(spark, moment_text):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frame = events(spark, (1, "I", 0)).withColumn("reg_at", moment(moment_text))
        found = feed.decode_events(feed.event_messages(frame)).selectExpr("cast(reg_at as string)").first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == moment_text


def test_a_stale_delete_in_a_later_batch_is_held_back(spark, tmp_path):
    batches = [events(spark, (1, "U", 5), (2, "I", 1), (2, "U", 2)), events(spark, (1, "D", 4), (2, "D", 3), (3, "I", 9))]
    checkpoint, landed, passed = (str(tmp_path / name) for name in ("checkpoint", "landed", "passed"))
    for batch in batches:
        stream.land_messages(feed.event_messages(batch), landed)
        frame = guard.newest_events(feed.decode_events(feed.read_feed_files(spark, landed, files_per_batch=100)))
        query = frame.writeStream.format("parquet").option("path", passed).option("checkpointLocation", checkpoint)
        query = query.trigger(availableNow=True).start()
        query.awaitTermination()
        state = query.lastProgress.stateOperators[0]
    found = rows(spark.read.schema(frame.schema).parquet(passed), "spent_idx", "indexing_type")
    assert found == [(1, "U"), (2, "D"), (2, "U"), (3, "I")]
    assert state.numRowsTotal >= 3  # one newest time for each key


def _guarded(spark, folder, batches, forget_after="7 days"):
    """What the guard lets through of the batches, one run of the stream for each."""
    for batch in batches:
        stream.land_messages(feed.event_messages(batch), f"{folder}/landed")
        frame = guard.newest_events(feed.decode_events(feed.read_feed_files(spark, f"{folder}/landed", files_per_batch=100)), forget_after)
        stream.copy_stream(frame, f"{folder}/passed", f"{folder}/checkpoint")
    return spark.read.schema(frame.schema).parquet(f"{folder}/passed")


def test_keys_of_one_block_are_guarded_each_by_its_own_time(spark, tmp_path):
    keys = range(-70, 140)
    first = [(key, "I", 10 + abs(key) % 7) for key in keys] + [(key, "U", 5) for key in keys]
    second = [(key, "D", 9 + abs(key) % 7 + key % 3) for key in keys]
    found = _guarded(spark, str(tmp_path), [events(spark, *first), events(spark, *second)])
    later = [(key, "D") for key in keys if key % 3 == 2]
    assert rows(found, "spent_idx", "indexing_type") == sorted([(key, "I") for key in keys] + later, key=repr)


def test_silent_keys_of_a_block_are_forgotten_and_their_neighbours_are_not(spark, tmp_path):
    folder, sizes = str(tmp_path), []
    for batch in ([(key, "I", 0) for key in range(40)] + [(40, "I", 15)], [(41, "I", 40)], [(42, "I", 41)]):
        stream.land_messages(feed.event_messages(events(spark, *batch)), f"{folder}/landed")
        frame = guard.newest_events(feed.decode_events(feed.read_feed_files(spark, f"{folder}/landed", 100)), "20 minutes")
        writer = frame.writeStream.format("parquet").option("path", f"{folder}/passed")
        query = writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        sizes.append(query.lastProgress.stateOperators[0].numRowsTotal)
    assert sizes[0] >= 41 and 3 <= sizes[-1] < 10
    handle, processor = _Counted(), guard._NewestEvent(1000)
    processor.init(handle)
    handle.known = {1: 5_000_000, 2: 6_000_000, 3: 8_000_000}
    list(processor.handleExpiredTimer((0,), SimpleNamespace(getCurrentWatermarkInMs=lambda: 7000), None))
    assert handle.known == {3: 8_000_000} and handle.timers == [9000]


class _Counted:
    """State and timers of one block in memory, with the number of requests."""

    def __init__(self):
        self.known, self.timers, self.requests = {}, [], 0

    def getMapState(self, name, key, value):  # noqa: N802
        return self

    def iterator(self):
        self.requests += 1
        return iter([((slot,), (at,)) for slot, at in self.known.items()])

    def updateValue(self, slot, at):  # noqa: N802
        self.requests += 1
        self.known[slot[0]] = at[0]

    def removeKey(self, slot):  # noqa: N802
        del self.known[slot[0]]

    def listTimers(self):  # noqa: N802
        self.requests += 1
        return iter(self.timers)

    def registerTimer(self, at):  # noqa: N802
        self.requests += 1
        self.timers.append(at)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.remove(at)


def test_the_guard_asks_the_state_once_for_a_block_and_once_for_a_newer_key():
    handle, processor = _Counted(), guard._NewestEvent(1000)
    processor.init(handle)
    ats = [5_000_000 + key for key in range(guard.BLOCK)]
    frame = pd.DataFrame({"spent_idx": range(guard.BLOCK), "partition_id": 0, "msg_offset": range(guard.BLOCK), "indexing_type": "I"})
    frame = frame.assign(at=ats, slot=frame["spent_idx"])
    doubled = [frame, frame.assign(msg_offset=-1, at=frame["at"] - 1)]
    (passed,) = processor.handleInputRows((0,), iter(doubled), None)
    assert passed["at"].sort_values().tolist() == ats and set(passed["msg_offset"]) == set(range(guard.BLOCK))
    assert handle.requests <= guard.BLOCK + 4
    assert list(processor.handleInputRows((0,), iter([frame]), None)) == []
    assert handle.requests <= guard.BLOCK + 5 and handle.timers == [6000]


def test_a_running_feed_notes_its_positions(spark, tmp_path):
    tables = spend_tables(spark, [(1, 1, True), (2, 1, True)])
    folder = str(tmp_path)
    for batch in (events(spark, (1, "U", 5), (2, "U", 6)), events(spark, (1, "D", 7))):
        messages = feed.event_messages(batch)
        if batch.count() == 1:
            messages = messages.withColumn("offset", F.lit(2).cast("bigint"))
        stream.land_messages(messages, f"{folder}/landed")
        source = feed.read_feed_files(spark, f"{folder}/landed")
        stream.start_feed(
            source, lambda: tables, f"{folder}/log", f"{folder}/checkpoint", lambda: NOW, positions=f"{folder}/positions", group="own"
        ).awaitTermination()
    reached = stream.read_positions(spark, f"{folder}/positions")
    assert rows(reached, "group_name", "partition_id", "committed_offset") == [("own", 0, 3)]
    offsets = spark.createDataFrame([("ref", 0, 3)], OFFSETS).unionByName(reached)
    assert rows(cdc.total_lag(offsets, "ref", "own")) == [(0, 0)]


def test_a_pull_takes_bounded_batches_and_stops_when_idle(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"), "spent_idx", ["spent_at"])
    tables = spend_tables(spark, [(1, 1, True)])
    store.publish(full_index(tables), datetime(2024, 1, 1), positions={0: 0})
    now, ends, ranges = [0.0], [{0: 5}, {0: 5}, {0: 5}, {0: 5}, {0: 6}], []

    def latest():
        return ends.pop(0) if len(ends) > 1 else ends[0]

    def apply(messages, end):
        commit = store.latest()
        none = store.spark.createDataFrame([], messages.schema)
        store.apply(none, NOW, positions=end, base=commit)

    def read(start, end):
        ranges.append((dict(start), dict(end)))
        return full_index(tables).withColumns({"event_at": moment(NOW), "op": F.lit("upsert")})

    batches = stream.pull(store, read, latest, apply, 2, 5, 1, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    assert [(a[0], b[0]) for a, b in ranges] == [(0, 2), (2, 4), (4, 5), (5, 6)] and batches == 4
    assert now[0] >= 5 and store.latest().positions == {"0": 6}
