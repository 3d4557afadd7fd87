"""Decoders for landed price, rate and holiday payloads.

Every decoder takes a frame with a payload column and keeps the other columns.
A payload that reports an error, or whose numbers do not parse, yields no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.fixed import HOLIDAY_OK, QUOTE_OK
from spendlake.schemas import HOLIDAY_PAYLOAD, PRICE_PAYLOAD, RATE_PAYLOAD, STOCK_QUOTE

_DECIMAL = "decimal(18,4)"
_JSON = {"mode": "PERMISSIVE"}


def _number(text: str | Column, kind: str) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.trim(column).try_cast(kind)


def _volume(text: str) -> Column:
    volume = _number(text, "bigint")
    return F.when(volume >= 0, volume)


def _domestic_fields() -> dict[str, Column]:
    out = "quote.output."
    return {
        "current_price": _number(out + "stck_prpr", _DECIMAL),
        "previous_price": _number(out + "stck_sdpr", _DECIMAL),
        "change_rate": _number(out + "prdy_ctrt", "double"),
        "high_price": _number(out + "stck_hgpr", _DECIMAL),
        "low_price": _number(out + "stck_lwpr", _DECIMAL),
        "volume": _volume(out + "acml_vol"),
    }


def _overseas_fields() -> dict[str, Column]:
    out = "quote.output."
    rate = F.regexp_replace(F.trim(F.col(out + "rate")), r"^\++", "")
    return {
        "current_price": _number(out + "last", _DECIMAL),
        "base_price": _number(out + "base", _DECIMAL),
        "price_diff": _number(out + "diff", _DECIMAL),
        "change_rate": _number(rate, "double"),
        "volume": _volume(out + "tvol"),
    }


def domestic_quotes(landed: DataFrame, payload: str = "payload") -> DataFrame:
    return _accepted_quotes(landed, payload, _domestic_fields())


def overseas_quotes(landed: DataFrame, payload: str = "payload") -> DataFrame:
    return _accepted_quotes(landed, payload, _overseas_fields())


def stock_prices(landed: DataFrame, overseas: Column, payload: str = "payload") -> DataFrame:
    """``current_price`` of accepted payloads, of the overseas form where ``overseas`` holds: one pass for both."""
    forms = {"abroad": _overseas_fields(), "home": _domestic_fields()}
    typed = {name: F.when(_is_ok(fields), fields["current_price"]) for name, fields in forms.items()}
    priced = _parsed(landed, payload).withColumn(
        "current_price", F.when(overseas, typed["abroad"]).otherwise(typed["home"])
    )
    return priced.drop("quote").filter(F.col("current_price").isNotNull())


def _parsed(landed: DataFrame, payload: str) -> DataFrame:
    return landed.withColumn("quote", F.from_json(payload, STOCK_QUOTE, _JSON)).drop(payload)


def _is_ok(fields: dict[str, Column]) -> Column:
    ok = F.col("quote.rt_cd") == QUOTE_OK
    for column in fields.values():
        ok = ok & column.isNotNull()
    return ok


def _accepted_quotes(landed: DataFrame, payload: str, fields: dict[str, Column]) -> DataFrame:
    kept = [name for name in landed.columns if name != payload]
    typed = _parsed(landed, payload).filter(F.col("quote.rt_cd") == QUOTE_OK)
    typed = typed.select(*kept, *[column.alias(name) for name, column in fields.items()])
    return typed.dropna(how="any", subset=list(fields))


def crypto_prices(landed: DataFrame, payload: str = "payload") -> DataFrame:
    text = F.from_json(payload, PRICE_PAYLOAD, _JSON)["price"]
    price = F.when(~text.rlike(r"\s"), text.try_cast(_DECIMAL))  # this feed's numbers are not trimmed
    return landed.withColumn("current_price", price).drop(payload).filter(F.col("current_price").isNotNull())


def exchange_rates(landed: DataFrame, payload: str = "payload") -> DataFrame:
    rate = F.from_json(payload, RATE_PAYLOAD, _JSON)["rate"]
    return landed.withColumn("rate", rate).drop(payload).filter(F.col("rate").isNotNull())


def holiday_dates(landed: DataFrame, payload: str = "payload") -> DataFrame:
    """Distinct official holidays of the accepted documents; impossible dates are left out."""
    parsed = landed.select(F.from_xml(payload, HOLIDAY_PAYLOAD).alias("doc"))
    accepted = parsed.filter((F.col("doc.header.resultCode") == HOLIDAY_OK) & (F.col("doc.body.totalCount") > 0))
    items = accepted.select(F.explode("doc.body.items.item").alias("item"))
    day = F.try_to_timestamp(F.trim("item.locdate"), F.lit("yyyyMMdd")).cast("date")
    dates = items.filter(F.col("item.isHoliday") == "Y").select(day.alias("dt"))
    return dates.filter(F.col("dt").isNotNull()).distinct()
