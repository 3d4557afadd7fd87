"""Price and exchange-rate updates from landed payloads, and price history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.fixed import OVERSEAS_CURRENCY
from spendlake.functions.dates import moment
from spendlake.operators import merge
from spendlake.sources import payloads


def stock_prices(stocks: DataFrame, landed: DataFrame, order_by: str | None = None) -> DataFrame:
    """Fetched price per stock; stocks whose payload failed drop out.

    ``stocks`` carries its market's currency, ``landed`` is ``(stock_seq, payload)``.
    Dollar stocks read the overseas payload form, all others the domestic one. A symbol that was fetched more than once
    has a row for each price; ``order_by``, say the landing time, stays with it.
    """
    fetched = stocks.join(landed, "stock_seq")
    priced = payloads.stock_prices(fetched, F.col("currency_code") == OVERSEAS_CURRENCY)
    return priced.select("stock_seq", "api_symbol", "currency_code", "stock_name", "current_price", *_named(order_by))


def crypto_prices(cryptos: DataFrame, landed: DataFrame, order_by: str | None = None) -> DataFrame:
    prices = payloads.crypto_prices(landed)
    return cryptos.join(prices, "crypto_seq").select(
        "crypto_seq", "api_symbol", "currency_code", "crypto_name", "current_price", *_named(order_by)
    )


def _named(order_by: str | None) -> list[str]:
    return [order_by] if order_by else []


def update_prices(
    table: DataFrame, prices: DataFrame, key: str, price: str, now: datetime | str, order_by: str | None = None
) -> DataFrame:
    """The instrument table with fetched prices and an update stamp; other rows as they were.

    Of several prices of one instrument the last by ``order_by`` counts; without an order they are an error.
    """
    new = prices.select(key, F.col("current_price").alias(price), *_named(order_by))
    return merge.update_columns(table, new, key, merge.batch_stamps(moment(now)), order_by)


def price_history(prices: DataFrame, key: str, name: str, now: datetime | str) -> DataFrame:
    """One history row per fetched price, the price as a double, with the day it belongs to."""
    at = moment(now)
    return prices.select(
        key,
        F.col("api_symbol").alias("symbol"),
        "currency_code",
        name,
        F.col("current_price").cast("double").alias("price"),
        at.alias("recorded_at"),
        at.cast("date").alias("recorded_date"),
    )


def append_history(history: DataFrame, path: str) -> None:
    """One folder per day."""
    merge.append_files(history, path, partition_by=["recorded_date"])


def update_rates(rates: DataFrame, fetched: DataFrame, now: datetime | str, order_by: str | None = None) -> DataFrame:
    """Active rate rows take the fetched rate, as decimal, by row key; the last one by ``order_by``."""
    key = "exchange_rate_snapshot_seq"
    new = fetched.select(key, F.col("rate").cast("decimal(18,8)").alias("exchange_rate"), *_named(order_by))
    return merge.update_columns(rates, new, key, merge.batch_stamps(moment(now)), order_by)
