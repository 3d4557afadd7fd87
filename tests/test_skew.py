"""A key with a third of all rows: joins split it, aggregates combine before the shuffle."""

from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from spendlake.operators import amounts, cdc
from spendlake.operators.denormalise import spends_for_index
from spendlake.session import stored, stored_tables

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.shuffle.partitions": "16",
}
ROWS = 60_000


@pytest.fixture
def no_broadcast(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hot(key, others):
    """Key 7 for a third of the rows."""
    return F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % others).cast("bigint").alias(key)


def scattered(spark, *columns):
    return spark.range(0, ROWS, 1, 12).select(*columns)


def splits(frame):
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().count("skew=true")


def test_a_hot_user_is_split(no_broadcast):
    spark = no_broadcast
    one = F.lit(1).cast("bigint")
    spent = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    tables = SimpleNamespace(
        spent_detail=scattered(
            spark, F.col("id").alias("spent_idx"), F.uuid().alias("spent_name"), F.col("id").alias("spent_money"),
            spent.alias("spent_at"), spent.alias("created_at"), F.lit(True).alias("should_index"),
            hot("user_seq", 5000), F.lit(1).cast("bigint").alias("consume_keyword_type_id"), one.alias("room_seq"),
            (F.col("id") % 5000).alias("payment_method_id"),
        ),
        keyword_type=spark.range(1, 2).select(
            F.col("id").alias("consume_keyword_type_id"), F.lit("k").alias("consume_keyword_type")
        ),
        users=spark.range(5000).select(F.col("id").alias("user_seq"), F.uuid().alias("user_id")),
        telegram_room=spark.range(1, 2).select(
            F.col("id").alias("room_seq"), F.lit(True).alias("is_room_approved"), one.alias("agg_group_seq")
        ),
        user_payment_methods=spark.range(5000).select(F.col("id").alias("payment_method_id"), F.uuid().alias("card_alias")),
        agg_group=spark.range(1, 2).select(F.col("id").alias("agg_group_seq"), F.lit(True).alias("is_active")),
    )
    index = spends_for_index(tables)
    assert index.count() == ROWS
    assert splits(spends_for_index(tables)) > 0


def test_a_hot_stock_is_split(no_broadcast):
    spark = no_broadcast
    holdings = scattered(spark, (F.col("id") % 9000).alias("user_seq"), hot("stock_seq", 5000), F.col("id").alias("stock_cnt"))
    stock = spark.range(5000).select(
        F.col("id").alias("stock_seq"), F.lit(1).cast("bigint").alias("market_seq"),
        F.lit(2).cast("decimal(18,4)").alias("stock_price"),
    )
    market = spark.range(1, 2).select(F.col("id").alias("market_seq"), F.lit("KRW").alias("currency_code"))
    assert splits(amounts.amount_per_user(amounts.stock_rows(holdings, stock, market))) > 0


def test_a_hot_key_of_the_feed_is_combined_before_the_shuffle(no_broadcast):
    spark = no_broadcast
    events = scattered(
        spark, hot("spent_idx", 50), F.lit("I").alias("indexing_type"), F.col("id").alias("msg_offset"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("reg_at"),
    )
    for frame in (cdc.latest_action(events), cdc.final_action(events)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "partial_max_by" in plan
        assert "collect_list" not in plan


def test_stored_tables_are_dropped_with_their_job(spark, tmp_path):
    result = str(tmp_path / "result")
    with stored_tables(spark):
        kept = stored(spark.range(3), "kept-for-a-while")
        folder = Path(kept.inputFiles()[0].removeprefix("file://")).parent
        kept.write.parquet(result)
        assert folder.exists()
    assert not folder.exists() and spark.read.parquet(result).count() == 3
