"""Joins that add names and currencies to spends, keywords and instruments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.schemas import INDEX_COLUMNS


def spends_for_index(tables, ids: DataFrame | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Indexable spends of approved rooms in active groups, with type, user, card and group.

    ``tables`` has the attributes ``spent_detail``, ``keyword_type``, ``users``,
    ``telegram_room``, ``user_payment_methods`` and ``agg_group``; ``ids`` narrows
    the spends to a frame of distinct keys, whose ``carry`` columns are added. Rooms are joined first because they drop rows.
    No join carries a broadcast hint: Spark picks one from the sizes it sees, and
    AQE splits a hot user or card where a side is too big to broadcast.
    """
    spends = tables.spent_detail.filter(F.col("should_index"))
    if ids is not None:
        spends = spends.join(ids.select("spent_idx", *carry), "spent_idx")
    groups = tables.agg_group.filter(F.col("is_active")).select("agg_group_seq")
    rooms = tables.telegram_room.filter(F.col("is_room_approved")).select("room_seq", "agg_group_seq")
    joined = (
        spends.join(rooms.join(groups, "agg_group_seq"), "room_seq")
        .join(tables.keyword_type.select("consume_keyword_type_id", "consume_keyword_type"), "consume_keyword_type_id")
        .join(tables.user_payment_methods.select("payment_method_id", "card_alias"), "payment_method_id")
        .join(tables.users.select("user_seq", "user_id"), "user_seq")
    )
    return joined.select(*[name for name in INDEX_COLUMNS if name not in ("updated_at", "updated_by")], *carry)


def full_index(tables) -> DataFrame:
    """Every index row, not stamped yet."""
    never = {"updated_at": F.lit(None).cast("timestamp_ntz"), "updated_by": F.lit(None).cast("string")}
    return spends_for_index(tables).withColumns(never).select(INDEX_COLUMNS)


def keywords_with_type(prodt_keyword: DataFrame, keyword_type: DataFrame) -> DataFrame:
    types = keyword_type.select("consume_keyword_type_id", "consume_keyword_type")
    return prodt_keyword.join(types, "consume_keyword_type_id").select(
        "consume_keyword_id", "consume_keyword", "keyword_weight", "consume_keyword_type_id", "consume_keyword_type"
    )


def stocks_with_market(stock: DataFrame, stock_type: DataFrame) -> DataFrame:
    markets = stock_type.select("market_seq", "market_alias", "currency_code")
    return stock.join(markets, "market_seq").select(
        "stock_seq", "stock_name", "api_symbol", "stock_price", "market_alias", "currency_code"
    )
