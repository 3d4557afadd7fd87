"""Value of each user's holdings per currency.

Each ``*_rows`` frame has one value per holding; ``amount_per_user`` sums them. The
asset snapshot sums all five kinds in one aggregate instead of joining five results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

_KEYS = ("user_seq", "currency_code")


def stock_rows(stock_asset: DataFrame, stock: DataFrame, stock_type: DataFrame) -> DataFrame:
    """Count times price; a stock without a price adds nothing."""
    priced = stock.filter(F.col("stock_price").isNotNull()).join(stock_type, "market_seq")
    held = stock_asset.join(priced.select("stock_seq", "stock_price", "currency_code"), "stock_seq")
    return held.select(*_KEYS, (F.col("stock_cnt").cast("decimal(12,0)") * F.col("stock_price")).alias("amount"))


def crypto_rows(crypto_asset: DataFrame, crypto: DataFrame, currency_code: DataFrame) -> DataFrame:
    """Count times price, for coins whose currency is known."""
    known = crypto.join(currency_code.select("currency_code"), "currency_code", "left_semi")
    held = crypto_asset.join(known.select("crypto_seq", "crypto_price", "currency_code"), "crypto_seq")
    return held.select(*_KEYS, (F.col("crypto_cnt") * F.col("crypto_price")).alias("amount"))


def cash_rows(cash_asset: DataFrame) -> DataFrame:
    return cash_asset.select(*_KEYS, F.col("cash").alias("amount"))


def deposit_rows(deposit_asset: DataFrame) -> DataFrame:
    """Ended deposits count as well."""
    return deposit_asset.select(*_KEYS, F.col("deposit_amount").alias("amount"))


def saving_rows(saving_asset: DataFrame) -> DataFrame:
    """Ended savings count as well."""
    return saving_asset.select(*_KEYS, F.col("accum_saving_amount").alias("amount"))


def amount_per_user(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy(*_KEYS).agg(total(rows, "amount").alias("asset_sum"))
    return sums.filter(F.col("asset_sum").isNotNull())


def total(rows: DataFrame, column: str) -> Column:
    """The sum as the widest decimal of the column's scale."""
    return F.sum(column).cast(DecimalType(38, rows.schema[column].dataType.scale))
