"""Table and message schemas as Spark DDL, and schemas read from index mapping files."""

from __future__ import annotations

import json

from pyspark.sql import types as T

_AUDIT = "created_at timestamp_ntz, updated_at timestamp_ntz, created_by string, updated_by string"


def _ddl(columns: str, audit: bool = True) -> str:
    return f"{columns}, {_AUDIT}" if audit else columns


TABLES: dict[str, str] = {
    "spent_detail": _ddl(
        "spent_idx bigint, spent_name string, spent_money bigint, spent_at timestamp_ntz, should_index boolean, "
        "user_seq bigint, spent_group_id bigint, consume_keyword_type_id bigint, room_seq bigint, "
        "payment_method_id bigint"
    ),
    "spent_detail_indexing": _ddl(
        "spent_idx bigint, spent_name string, spent_money bigint, spent_at timestamp_ntz, "
        "created_at timestamp_ntz, user_seq bigint, consume_keyword_type_id bigint, consume_keyword_type string, "
        "room_seq bigint, user_id string, card_alias string, updated_at timestamp_ntz, updated_by string, "
        "agg_group_seq bigint",
        audit=False,
    ),
    "keyword_type": _ddl("consume_keyword_type_id bigint, consume_keyword_type string"),
    "prodt_keyword": _ddl(
        "consume_keyword_id bigint, consume_keyword string, keyword_weight int, consume_keyword_type_id bigint"
    ),
    "users": _ddl("user_seq bigint, user_id string"),
    "telegram_room": _ddl(
        "room_seq bigint, room_token string, is_room_approved boolean, user_seq bigint, agg_group_seq bigint"
    ),
    "agg_group": _ddl("agg_group_seq bigint, agg_group_name string, is_active boolean"),
    "send_email_agg_group": _ddl("agg_group_seq bigint, email_id string, is_active boolean"),
    "users_email": _ddl("email_id string, user_seq bigint, is_recv boolean"),
    "user_payment_methods": _ddl(
        "payment_method_id bigint, payment_type_cd string, payment_category_cd string, card_id string, "
        "card_alias string, is_active boolean, is_default boolean, user_seq bigint, card_company_nm string"
    ),
    "spent_group_info": _ddl("spent_group_id bigint, spent_group_nm string, status string"),
    "earned_detail": _ddl(
        "earned_idx bigint, earned_name string, earned_money bigint, earned_money_dollor decimal(18,4), "
        "earned_at timestamp_ntz, user_seq bigint, room_seq bigint"
    ),
    "dim_calendar": _ddl(
        "dt date, yyyy smallint, mm tinyint, dd tinyint, yyyymm string, yyyymmdd string, day_of_month tinyint, "
        "quarter_no tinyint, half_no tinyint, weekday_no tinyint, is_weekend tinyint, is_weekday tinyint, "
        "is_month_start tinyint, is_month_end tinyint, remaining_days_in_month tinyint, is_holiday tinyint, "
        "is_before_holiday tinyint, is_after_holiday tinyint"
    ),
    "currency_code": _ddl("currency_code string, currency_name string, country_code string, is_active boolean"),
    "currency_exchange_rate_snapshot": _ddl(
        "exchange_rate_snapshot_seq bigint, base_currency_code string, target_currency_code string, "
        "base_amount decimal(18,4), exchange_rate decimal(18,8), is_active boolean"
    ),
    "stock_type": _ddl("market_seq bigint, market string, market_alias string, currency_code string"),
    "stock": _ddl(
        "stock_seq bigint, market_seq bigint, stock_name string, api_symbol string, stock_price decimal(18,4), "
        "stock_alias string"
    ),
    "stock_asset": _ddl(
        "stock_asset_seq bigint, stock_cnt bigint, avg_purchase_price decimal(18,4), user_seq bigint, "
        "stock_seq bigint"
    ),
    "crypto": _ddl(
        "crypto_seq bigint, crypto_name string, crypto_price decimal(18,4), api_symbol string, currency_code string"
    ),
    "crypto_asset": _ddl(
        "crypto_asset_seq bigint, crypto_cnt decimal(18,8), avg_purchase_price decimal(18,4), crypto_seq bigint, "
        "user_seq bigint"
    ),
    "cash_asset": _ddl(
        "cash_seq bigint, cash_name string, cash decimal(18,4), user_seq bigint, currency_code string"
    ),
    "deposit_asset": _ddl(
        "deposit_seq bigint, deposit_name string, deposit_amount decimal(18,4), interest_rate decimal(9,4), "
        "deposit_start_date timestamp_ntz, deposit_end_date timestamp_ntz, user_seq bigint, currency_code string, "
        "is_terminated boolean, term_month int"
    ),
    "saving_asset": _ddl(
        "saving_seq bigint, saving_name string, saving_amount decimal(18,4), accum_saving_amount decimal(18,4), "
        "interest_rate decimal(9,4), term_month int, saving_start_date timestamp_ntz, "
        "saving_end_date timestamp_ntz, is_terminated boolean, user_seq bigint, currency_code string"
    ),
    "user_current_asset_snapshot": _ddl(
        "summary_seq bigint, user_seq bigint, currency_code string, aggregated_at timestamp_ntz, "
        "cash_amount decimal(38,4), stock_amount decimal(38,4), crypto_amount decimal(38,12), "
        "deposit_amount decimal(38,4), saving_amount decimal(38,4)"
    ),
}

INDEX_COLUMNS: list[str] = [column.split()[0] for column in TABLES["spent_detail_indexing"].split(", ")]

GROUP_OFFSET = "group_name string, partition_id int, committed_offset bigint"

CDC_EVENT = "spent_idx bigint, indexing_type string, reg_at timestamp"

# Both stock quote forms: the first line of ``output`` is the domestic one, the second the overseas one.
STOCK_QUOTE = (
    "rt_cd string, msg_cd string, msg1 string, output struct<"
    "stck_prpr: string, stck_sdpr: string, prdy_ctrt: string, stck_hgpr: string, stck_lwpr: string, acml_vol: string, "
    "last: string, base: string, diff: string, rate: string, tvol: string>"
)
PRICE_PAYLOAD = "price string, code int, message string"
RATE_PAYLOAD = "rate double, code int, message string"
HOLIDAY_PAYLOAD = (
    "header struct<resultCode: string, resultMsg: string>, "
    "body struct<items: struct<item: array<struct<locdate: string, isHoliday: string>>>, totalCount: bigint>"
)

# Field types of an index mapping and the column types they become.
_MAPPING_TYPES = {
    "text": T.StringType(),
    "keyword": T.StringType(),
    "long": T.LongType(),
    "integer": T.IntegerType(),
    "short": T.ShortType(),
    "byte": T.ByteType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "date": T.TimestampNTZType(),
}


def schema_from_mapping(mapping: str | dict) -> T.StructType:
    """Columns of an index mapping. ``mappings`` is required, ``settings`` is optional and not used."""
    document = json.loads(mapping) if isinstance(mapping, str) else mapping
    if "mappings" not in document:
        raise ValueError("the mapping document has no 'mappings'")
    return _fields(document["mappings"].get("properties", {}))


def _fields(properties: dict) -> T.StructType:
    schema = T.StructType()
    for name, spec in properties.items():
        if "properties" in spec:
            schema.add(name, _fields(spec["properties"]))
        elif spec.get("type") in _MAPPING_TYPES:
            schema.add(name, _MAPPING_TYPES[spec["type"]])
        else:
            raise ValueError(f"field {name!r} has unsupported type {spec.get('type')!r}")
    return schema
