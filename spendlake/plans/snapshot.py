"""Asset snapshot: five totals for every user and market currency."""

from __future__ import annotations

import functools
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.fixed import SNAPSHOT_USER
from spendlake.functions.dates import moment
from spendlake.operators import amounts
from spendlake.operators.merge import append_files

KINDS = ("cash", "stock", "crypto", "deposit", "saving")

def _market_currencies(stock_type: DataFrame) -> Column:
    """Distinct currencies of the markets as one array value: codes of three letters, however many markets."""
    return stock_type.select("currency_code").distinct().agg(F.array_sort(F.collect_list("currency_code"))).scalar()


def _dealt(rows: DataFrame) -> DataFrame:
    """The rows over all shuffle partitions, however few files hold them.

    A narrow table packs millions of users into one file, or one row group of it, and what combines them before the
    shuffle holds a group for each. All columns deal, so one user's many rows go to many tasks.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *rows.columns)


def _named(rows: DataFrame, kind: str) -> DataFrame:
    return rows.withColumnRenamed("amount", f"{kind}_amount")


def _union(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def asset_snapshot(tables, now: datetime | str) -> DataFrame:
    """One row per user and currency, zeros included.

    The users' rows and all holdings go into one union and one aggregate: a single
    shuffle on (user, currency), combined before it. Users, cash, deposits and savings, with a group for nearly every
    row of a file, are dealt first; stock and coins come from joins, which shuffle large ones. Holdings outside the users or
    currencies of the snapshot fall out with the filter on ``listed``.
    """
    joined = [
        _named(amounts.stock_rows(tables.stock_asset, tables.stock, tables.stock_type), "stock"),
        _named(amounts.crypto_rows(tables.crypto_asset, tables.crypto, tables.currency_code), "crypto"),
    ]
    read = [
        _named(amounts.cash_rows(tables.cash_asset), "cash"),
        _named(amounts.deposit_rows(tables.deposit_asset), "deposit"),
        _named(amounts.saving_rows(tables.saving_asset), "saving"),
    ]
    listed = _dealt(tables.users.select("user_seq")).select(
        "user_seq", F.explode(_market_currencies(tables.stock_type)).alias("currency_code"), F.lit(True).alias("listed")
    )
    everything = _union([listed, *joined, _dealt(_union(read))])
    sums = [amounts.total(everything, f"{kind}_amount").alias(f"{kind}_amount") for kind in KINDS]
    totals = everything.groupBy("user_seq", "currency_code").agg(F.max("listed").alias("listed"), *sums)
    zeroed = [F.coalesce(F.col(f"{k}_amount"), F.lit(0).cast("decimal(1,0)")).alias(f"{k}_amount") for k in KINDS]
    at = moment(now)
    return totals.filter("listed").select(
        "user_seq",
        "currency_code",
        at.alias("aggregated_at"),
        *zeroed,
        at.alias("created_at"),
        F.lit(SNAPSHOT_USER).alias("created_by"),
    )


def append_snapshot(rows: DataFrame, path: str) -> None:
    """Adds a snapshot, one folder per day."""
    append_files(rows.withColumn("snapshot_date", F.col("aggregated_at").cast("date")), path, ["snapshot_date"])
