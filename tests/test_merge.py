from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from spendlake.functions.dates import moment
from spendlake.operators import merge

TABLE = "id bigint, name string, amount bigint"


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", None)], TABLE)


def test_upsert_replaces_whole_rows_and_adds_new_ones(spark, table):
    batch = spark.createDataFrame([(2, None, 21), (9, "z", 90)], TABLE)
    assert rows(merge.upsert(table, batch, "id")) == [(1, "a", 10), (2, None, 21), (3, "c", None), (9, "z", 90)]


def test_upsert_keeps_the_last_of_repeated_keys(spark, table):
    batch = spark.createDataFrame([(2, "old", 1, 5), (2, "new", 2, 7), (2, "mid", 3, 6)], TABLE + ", seen bigint")
    assert (2, "new", 2) in rows(merge.upsert(table, batch, "id", order_by="seen"))


def test_upsert_without_a_key_is_an_error(spark, table):
    batch = spark.createDataFrame([(None, "x", 1)], TABLE)
    with pytest.raises(Exception, match="row without a id"):
        merge.upsert(table, batch, "id").collect()


def test_partial_upsert_changes_supplied_columns_only(spark, table):
    batch = spark.createDataFrame([(1, None), (7, 70)], "id bigint, amount bigint")
    result = rows(merge.partial_upsert(table, batch, "id"))
    assert result == [(1, "a", None), (2, "b", 20), (3, "c", None), (7, None, 70)]


def test_repeated_keys_give_one_row_or_an_error(spark, table):
    batch = spark.createDataFrame([(1, 5, None), (1, 6, 2), (1, 7, 1)], "id bigint, amount bigint, seen bigint")
    assert (1, "a", 6) in rows(merge.update_columns(table, batch, "id", order_by="seen"))
    assert (1, "a", 6) in rows(merge.partial_upsert(table, batch, "id", order_by="seen"))
    for call in (merge.update_columns, merge.partial_upsert):
        assert len(rows(call(table, batch, "id", order_by="seen"))) == 3
        with pytest.raises(Exception, match="repeats without an order"):
            call(table, batch.drop("seen"), "id").collect()
    with pytest.raises(Exception, match="repeats without an order"):
        merge.upsert(table, batch.selectExpr("id", "'x' as name", "amount"), "id").collect()


def test_a_row_without_an_order_value_still_counts(spark, table):
    batch = spark.createDataFrame([(2, "new", 1, None)], TABLE + ", seen bigint")
    assert (2, "new", 1) in rows(merge.upsert(table, batch, "id", order_by="seen"))


def test_delete_ignores_unknown_ids(spark, table):
    ids = spark.createDataFrame([(2,), (99,)], "id bigint")
    assert rows(merge.delete(table, ids, "id"), "id") == [(1,), (3,)]


def test_update_columns_keeps_unmatched_rows(spark, table):
    updates = spark.createDataFrame([(1, 11), (99, 5)], "id bigint, amount bigint")
    assert rows(merge.update_columns(table, updates, "id")) == [(1, "a", 11), (2, "b", 20), (3, "c", None)]


def test_index_rows_are_stamped_and_ungrouped_rows_get_group_zero(spark):
    index = spark.createDataFrame(
        [(1, 5, None, None)], "id bigint, agg_group_seq bigint, updated_at timestamp_ntz, updated_by string"
    )
    new = spark.createDataFrame([(2, None)], "id bigint, agg_group_seq bigint")
    result = merge.upsert_index_rows(index, new, "id", moment("2024-01-01 00:00:00"))
    assert (2, 0, datetime(2024, 1, 1), "batch") in rows(result)


def test_creation_columns_survive_an_upsert(spark):
    columns = (
        "id bigint, flag int, created_at timestamp_ntz, created_by string, updated_at timestamp_ntz, updated_by string"
    )
    day = datetime(2020, 1, 1)
    old = spark.createDataFrame([(1, 0, day, "seed", None, None), (2, 0, day, "seed", None, None)], columns)
    later = datetime(2024, 1, 1)
    new = spark.createDataFrame([(1, 1, later, "batch", None, None), (3, 1, later, "batch", None, None)], columns)
    result = rows(merge.upsert_keeping_creation(old, new, "id", moment("2024-01-01 00:00:00")))
    assert result == [
        (1, 1, day, "seed", later, "batch"),
        (2, 0, day, "seed", None, None),
        (3, 1, later, "batch", None, None),
    ]


def test_append_with_generated_id(spark, table, tmp_path):
    path = str(tmp_path / "rows")
    merge.append_files(table, path, id_column="doc_id")
    merge.append_files(table, path, id_column="doc_id")
    stored = spark.read.parquet(path)
    assert stored.count() == 6
    assert stored.select("doc_id").distinct().count() == 6


def test_append_frame(spark, table):
    assert merge.append(table, table.filter(F.col("id") == 1)).count() == 4
