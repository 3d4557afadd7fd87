"""Payloads as they would have been landed by the fetchers, derived from the domain tables."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.operators.denormalise import stocks_with_market

def _text(number: Column) -> Column:
    return F.coalesce(number.cast("string"), F.lit("n/a"))


def _padded(number: Column) -> Column:
    return F.concat(F.lit(" "), _text(number), F.lit(" "))


def stock_payloads(tables) -> DataFrame:
    """``(stock_seq, currency_code, payload)``: the overseas form for dollar stocks, the domestic one for others."""
    price = F.col("stock_price")
    status = F.when(F.col("stock_name").startswith("old"), "1").otherwise("0")
    head = [status.alias("rt_cd"), F.lit("M1").alias("msg_cd"), F.lit("done").alias("msg1")]
    overseas = F.struct(
        _padded(price + F.lit("1.25").cast("decimal(3,2)")).alias("last"),
        _text(price).alias("base"),
        F.lit("1.25").alias("diff"),
        F.lit(" +1.50").alias("rate"),
        _text(F.col("stock_seq") * 10).alias("tvol"),
    )
    domestic = F.struct(
        _padded(price + F.lit("1.25").cast("decimal(3,2)")).alias("stck_prpr"),
        _text(price).alias("stck_sdpr"),
        F.lit("-0.75 ").alias("prdy_ctrt"),
        _text(price + 2).alias("stck_hgpr"),
        _text(price - 2).alias("stck_lwpr"),
        _text(F.col("stock_seq") * 10).alias("acml_vol"),
    )
    payload = F.when(
        F.col("currency_code") == "USD", F.to_json(F.struct(*head, overseas.alias("output")))
    ).otherwise(F.to_json(F.struct(*head, domestic.alias("output"))))
    return stocks_with_market(tables.stock, tables.stock_type).select(
        "stock_seq", "currency_code", payload.alias("payload")
    )


def stock_payloads_twice(tables) -> DataFrame:
    """The same, and for every fifth stock a second one, landed later, one dearer; ``landed_at`` orders them."""
    later = SimpleNamespace(
        stock=tables.stock.filter(F.col("stock_seq") % 5 == 0).withColumn(
            "stock_price", (F.col("stock_price") + 1).cast("decimal(18,4)")
        ),
        stock_type=tables.stock_type,
    )
    both = stock_payloads(tables).withColumn("landed_at", F.lit(1))
    return both.unionByName(stock_payloads(later).withColumn("landed_at", F.lit(2)))


def crypto_payloads(tables) -> DataFrame:
    price = F.to_json(F.struct((F.col("crypto_price") + F.lit("0.5").cast("decimal(2,1)")).cast("string").alias("price")))
    error = F.to_json(F.struct(F.lit(404).alias("code"), F.lit("unknown symbol").alias("message")))
    return tables.crypto.select(
        "crypto_seq", F.when(F.col("currency_code") == "EUR", error).otherwise(price).alias("payload")
    )


def rate_payloads(rates: DataFrame) -> DataFrame:
    rate = F.to_json(F.struct((F.col("exchange_rate").cast("double") * 1.01).alias("rate")))
    error = F.to_json(F.struct(F.lit(400).alias("code"), F.lit("unknown pair").alias("message")))
    return rates.select(
        "exchange_rate_snapshot_seq",
        F.when(F.col("base_currency_code") == "CNY", error).otherwise(rate).alias("payload"),
    )


def holiday_documents(tables) -> DataFrame:
    """One XML document per month with spends: its dates, the holidays marked, and one impossible date.

    A month's list holds distinct dates, so at most 31.
    """
    days = tables.orders.select(F.col("o_orderdate").cast("date").alias("dt")).distinct()
    marked = days.join(tables.holiday.withColumn("flag", F.lit("Y")), "dt", "left")
    item = F.concat(
        F.lit("<item><locdate>"),
        F.date_format("dt", "yyyyMMdd"),
        F.lit("</locdate><isHoliday>"),
        F.coalesce("flag", F.lit("N")),
        F.lit("</isHoliday></item>"),
    )
    months = marked.groupBy(F.date_format("dt", "yyyyMM").alias("month")).agg(
        F.array_join(F.collect_list(item), "").alias("items"), F.count(F.lit(1)).alias("n")
    )
    document = F.concat(
        F.lit("<response><header><resultCode>00</resultCode><resultMsg>OK</resultMsg></header><body><items>"),
        F.col("items"),
        F.lit("<item><locdate>"),
        F.col("month"),
        F.lit("32</locdate><isHoliday>Y</isHoliday></item></items><totalCount>"),
        F.col("n").cast("string"),
        F.lit("</totalCount></body></response>"),
    )
    return months.select(document.alias("payload"))
