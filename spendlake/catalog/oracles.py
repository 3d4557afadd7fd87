"""For each query the SQL that gives the same rows straight from the tables.

The statements state the wanted result in their own way: payload queries, for
example, are checked against the tables the payloads were made from, and the
text search against a plain join of all tokens.
"""

from __future__ import annotations

from spendlake import fixed
from spendlake.sources.views import with_views

NOW = "timestamp '2024-02-01 00:00:00'"
EARLIER = "timestamp '2020-01-01 00:00:00'"
# Report moment 2000-06-15 12:00; starts are at 09:00 UTC.
MONTH_END = "timestamp '2000-06-15 12:00:00'"
MONTH_START = "timestamp '2000-05-15 09:00:00'"
MONTH_BEFORE = "timestamp '2000-04-15 09:00:00'"
WEEK_START = "timestamp '2000-06-08 09:00:00'"
WEEK_BEFORE = "timestamp '2000-06-01 09:00:00'"

SPEND_TABLES = (
    "spent_detail", "keyword_type", "users", "telegram_room", "user_payment_methods", "agg_group",
)
INDEX = """idx as (
  select s.spent_idx, s.spent_name, s.spent_money, s.spent_at, s.created_at, s.user_seq,
    s.consume_keyword_type_id, t.consume_keyword_type, s.room_seq, u.user_id, p.card_alias, g.agg_group_seq
  from spent_detail s
  join keyword_type t on t.consume_keyword_type_id = s.consume_keyword_type_id
  join users u on u.user_seq = s.user_seq
  join telegram_room r on r.room_seq = s.room_seq
  join user_payment_methods p on p.payment_method_id = s.payment_method_id
  join agg_group g on g.agg_group_seq = r.agg_group_seq
  where s.should_index and r.is_room_approved and g.is_active)"""
KEYED = """keyed as (
  select spent_idx, spent_name, spent_money, consume_keyword_type_id from spent_detail)"""
LATEST = """latest as (
  select spent_idx, kind as indexing_type, case when kind = 'D' then 'delete' else 'upsert' end as action, reg_at
  from (select spent_idx, upper(indexing_type[1]) as kind, reg_at,
      row_number() over (partition by spent_idx order by reg_at desc, msg_offset) as place from cdc_event) e
  where place = 1)"""
RECIPIENTS = """recipients as (
  select agg_group_seq, email_id from send_email_agg_group where is_active)"""
KEYWORDS = """keywords as (
  select k.consume_keyword_id, k.consume_keyword, k.keyword_weight, t.consume_keyword_type_id, t.consume_keyword_type
  from prodt_keyword k join keyword_type t on t.consume_keyword_type_id = k.consume_keyword_type_id)"""


def statement(views: tuple[str, ...], body: str, *ctes: str) -> str:
    return f"with {', '.join([with_views(*views), *ctes])} {body}"


ORACLES: dict[str, str] = {}

# Sources

ORACLES["scan_spent_detail"] = statement(("spent_detail",), "select * from spent_detail")
ORACLES["active_rates"] = statement(
    ("currency_exchange_rate_snapshot",),
    "select exchange_rate_snapshot_seq, base_currency_code, target_currency_code, exchange_rate "
    "from currency_exchange_rate_snapshot where is_active",
)
ORACLES["active_email_groups"] = statement(("send_email_agg_group",), "select * from recipients", RECIPIENTS)
ORACLES["lookup_by_ids"] = statement(
    ("spent_detail", "cdc_event"),
    "select * from keyed where spent_idx in (select spent_idx from cdc_event)",
    KEYED,
)
_EVENTS = "select partition_id, partition_offset as msg_offset, spent_idx, indexing_type, reg_at from cdc_event"
ORACLES["cdc_source"] = statement(("cdc_event",), _EVENTS)
ORACLES["cdc_decode"] = statement(("cdc_event",), _EVENTS)
ORACLES["holiday_dates"] = statement(("holiday",), "select dt from holiday")

_MARKET_STOCK = """priced as (
  select s.stock_seq, s.stock_name, s.api_symbol, s.stock_price, m.currency_code,
    cast(s.stock_price + 1.25 as decimal(18,4)) as new_price
  from stock s join stock_type m on m.market_seq = s.market_seq),
fetched as (select * from priced where stock_price is not null and stock_name not like 'old%')"""
ORACLES["quotes_domestic"] = statement(
    ("stock", "stock_type"),
    "select stock_seq, new_price as current_price, stock_price as previous_price, cast(-0.75 as double) as change_rate, "
    "cast(stock_price + 2 as decimal(18,4)) as high_price, cast(stock_price - 2 as decimal(18,4)) as low_price, "
    "stock_seq * 10 as volume from fetched where currency_code <> 'USD'",
    _MARKET_STOCK,
)
ORACLES["quotes_overseas"] = statement(
    ("stock", "stock_type"),
    "select stock_seq, new_price as current_price, stock_price as base_price, "
    "cast(1.25 as decimal(18,4)) as price_diff, cast(1.5 as double) as change_rate, stock_seq * 10 as volume "
    "from fetched where currency_code = 'USD'",
    _MARKET_STOCK,
)
ORACLES["quotes_crypto"] = statement(
    ("crypto",),
    "select crypto_seq, cast(crypto_price + 0.5 as decimal(18,4)) as current_price from crypto "
    "where currency_code <> 'EUR'",
)
_RATE = "cast(exchange_rate as double) * cast(1.01 as double)"
ORACLES["quotes_fx"] = statement(
    ("currency_exchange_rate_snapshot",),
    f"select exchange_rate_snapshot_seq, {_RATE} as rate from currency_exchange_rate_snapshot "
    "where is_active and base_currency_code <> 'CNY'",
)

# Writes

ORACLES["bulk_upsert"] = statement(
    ("spent_detail", "cdc_event"),
    "select spent_idx, spent_name, spent_money, consume_keyword_type_id from keyed "
    "where spent_idx not in (select spent_idx from cdc_event) union all "
    "select spent_idx, 'event ' || indexing_type, msg_offset * 10, cast(1 as bigint) from cdc_event "
    "where msg_offset in (select max(msg_offset) from cdc_event group by spent_idx)",
    KEYED,
)
ORACLES["bulk_append"] = statement(("spent_detail",), "select * from keyed", KEYED)
ORACLES["bulk_partial_upsert"] = statement(
    ("spent_detail", "cdc_event"),
    "select coalesce(k.spent_idx, l.spent_idx) as spent_idx, k.spent_name, "
    "case when l.action = 'upsert' then 7 when l.action = 'delete' then null else k.spent_money end as spent_money, "
    "k.consume_keyword_type_id from keyed k full join latest l on l.spent_idx = k.spent_idx",
    KEYED,
    LATEST,
)
ORACLES["bulk_delete"] = statement(
    ("spent_detail", "cdc_event"),
    "select * from keyed where spent_idx not in (select spent_idx from latest where action = 'delete')",
    KEYED,
    LATEST,
)
ORACLES["bulk_case_update"] = statement(
    ("spent_detail", "cdc_event"),
    "select spent_idx, spent_name, spent_money, case when spent_idx in (select spent_idx from latest "
    f"where action = 'upsert') then {fixed.DEFAULT_TYPE_ID} else consume_keyword_type_id end as consume_keyword_type_id "
    "from keyed",
    KEYED,
    LATEST,
)
_STAMPS = (
    "select idx.*, case when {touched} then {now} end as updated_at, "
    "case when {touched} then 'batch' end as updated_by from idx"
)
_UPSERTED = "spent_idx in (select spent_idx from latest where action = 'upsert')"
_DELETED = "spent_idx in (select spent_idx from latest where action = 'delete')"
ORACLES["spend_index_upsert"] = statement(
    (*SPEND_TABLES, "cdc_event"), _STAMPS.format(touched=_UPSERTED, now=NOW), INDEX, LATEST
)

_CALENDAR = """years as (
  select min(extract(year from o_orderdate)) as y0, max(extract(year from o_orderdate)) as y1 from orders),
days as (
  select cast(unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), interval 1 day)) as date) as dt
  from years),
parts as (
  select dt, cast(year(dt) as int) as yyyy, cast(month(dt) as int) as mm, cast(day(dt) as int) as dd,
    strftime(dt, '%Y%m') as yyyymm, strftime(dt, '%Y%m%d') as yyyymmdd, cast(day(dt) as int) as day_of_month,
    cast(quarter(dt) as int) as quarter_no, case when month(dt) <= 6 then 1 else 2 end as half_no,
    cast(isodow(dt) - 1 as int) as weekday_no, case when isodow(dt) >= 6 then 1 else 0 end as is_weekend,
    case when isodow(dt) >= 6 then 0 else 1 end as is_weekday,
    case when day(dt) <= 4 then 1 else 0 end as is_month_start,
    case when day(last_day(dt)) - day(dt) <= 3 then 1 else 0 end as is_month_end,
    cast(day(last_day(dt)) - day(dt) as int) as remaining_days_in_month,
    case when dt in (select dt from holiday) then 1 else 0 end as is_holiday,
    case when dt + 1 in (select dt from holiday) then 1 else 0 end as is_before_holiday,
    case when dt - 1 in (select dt from holiday) then 1 else 0 end as is_after_holiday
  from days)"""
ORACLES["dim_calendar"] = statement(
    ("holiday",),
    f"select *, {NOW} as created_at, 'batch' as created_by, cast(null as timestamp) as updated_at, "
    "cast(null as varchar) as updated_by from parts",
    _CALENDAR,
)
ORACLES["calendar_upsert"] = statement(
    ("holiday",),
    f"select parts.*, case when yyyy <= y0 + 2 then {EARLIER} else {NOW} end as created_at, "
    "case when yyyy <= y0 + 2 then 'seed' else 'batch' end as created_by, "
    f"case when yyyy <= y0 + 2 then {NOW} end as updated_at, "
    "case when yyyy <= y0 + 2 then 'batch' end as updated_by from parts cross join years",
    _CALENDAR,
)
ORACLES["publish_spent_detail"] = statement(
    SPEND_TABLES,
    "select idx.*, cast(null as timestamp) as updated_at, cast(null as varchar) as updated_by from idx",
    INDEX,
)
ORACLES["produce_json"] = statement(
    ("spent_detail",),
    "select cast(spent_idx as varchar) as key, '{\"spent_idx\":' || spent_idx || ',\"spent_name\":\"' || spent_name "
    "|| '\",\"spent_money\":' || spent_money || ',\"user_seq\":' || user_seq || '}' as value from spent_detail",
)
ORACLES["copy_offsets"] = statement(
    ("group_offset",),
    "select * from group_offset where group_name = 'ref' union all "
    "select 'catchup', partition_id, committed_offset from group_offset where group_name = 'ref' union all "
    "select * from group_offset where group_name = 'catchup' and partition_id not in "
    "(select partition_id from group_offset where group_name = 'ref')",
)

# Joins

ORACLES["spent_detail_indexing"] = statement(SPEND_TABLES, "select * from idx", INDEX)
ORACLES["spent_type_keywords"] = statement(("prodt_keyword", "keyword_type"), "select * from keywords", KEYWORDS)
ORACLES["stock_with_market"] = statement(
    ("stock", "stock_type"),
    "select s.stock_seq, s.stock_name, s.api_symbol, s.stock_price, m.market_alias, m.currency_code "
    "from stock s join stock_type m on m.market_seq = s.market_seq",
)
_LAG = """lag as (
  select coalesce(r.partition_id, c.partition_id) as partition_id,
    coalesce(r.committed_offset, 0) as reference_offset, coalesce(c.committed_offset, 0) as catchup_offset,
    greatest(coalesce(r.committed_offset, 0) - coalesce(c.committed_offset, 0), 0) as lag
  from (select * from group_offset where group_name = 'ref') r
  full join (select * from group_offset where group_name = 'catchup') c on c.partition_id = r.partition_id)"""
ORACLES["consumer_lag"] = statement(("group_offset",), "select * from lag", _LAG)
ORACLES["consumer_lag_total"] = statement(
    ("group_offset",),
    "select cast(sum(lag) as bigint) as total_lag, "
    "cast(greatest(sum(reference_offset) - sum(catchup_offset), 0) as bigint) as lag_of_totals from lag",
    _LAG,
)

# Classifier. All ids of one spend name share its tokens, so names are matched once each.

_SEARCH = f"""names as (select distinct spent_name from spent_detail),
name_token as (
  select spent_name, token, count(*) as times from (
    select spent_name, unnest(regexp_split_to_array(lower(spent_name), '[^a-z0-9]+')) as token from names) t
  where token <> '' group by spent_name, token),
keyword_token as (
  select consume_keyword_id as keyword_id, token, count(*) as tf from (
    select consume_keyword_id, unnest(regexp_split_to_array(lower(consume_keyword), '[^a-z0-9]+')) as token
    from keywords) t
  where token <> '' group by consume_keyword_id, token),
keyword_length as (select keyword_id, sum(tf) as len from keyword_token group by keyword_id),
corpus as (select count(*) as n, avg(len) as mean_len from keyword_length),
spread as (select token, count(*) as df from keyword_token group by token),
share as (
  select k.keyword_id, k.token, cast(round({1_000_000} * ln(1 + (c.n - s.df + 0.5) / (s.df + 0.5)) * k.tf
      * {fixed.BM25_K1 + 1} / (k.tf + {fixed.BM25_K1} * (1 - {fixed.BM25_B} + {fixed.BM25_B} * l.len / c.mean_len)))
      as bigint) as weight
  from keyword_token k join keyword_length l on l.keyword_id = k.keyword_id
  join spread s on s.token = k.token cross join corpus c),
scored as (
  select n.spent_name, k.keyword_id, cast(sum(n.times * k.weight) as bigint) as score
  from name_token n join share k on k.token = n.token group by n.spent_name, k.keyword_id),
hits as (
  select * from (select *, cast(row_number() over (partition by spent_name order by score desc, keyword_id) as int)
    as hit_rank from scored) r where hit_rank <= {fixed.HITS_PER_NAME})"""
_VERDICT = f"""judged as (
  select h.spent_name, k.*, h.hit_rank, levenshtein(k.consume_keyword, h.spent_name)
    - cast(trunc(h.score * k.keyword_weight / 1000000.0) as bigint) as combined
  from hits h join keywords k on k.consume_keyword_id = h.keyword_id),
best as (
  select * from (select *, row_number() over (partition by spent_name order by combined, hit_rank desc) as place
    from judged) j where place = 1),
verdict as (
  select n.spent_name,
    coalesce(b.consume_keyword_type_id, {fixed.DEFAULT_TYPE_ID}) as consume_keyword_type_id,
    coalesce(b.consume_keyword_type, '{fixed.DEFAULT_TYPE}') as consume_keyword_type,
    coalesce(b.consume_keyword, n.spent_name) as consume_keyword,
    coalesce(b.keyword_weight, {fixed.DEFAULT_WEIGHT}) as keyword_weight, b.combined as combined_score
  from names n left join best b on b.spent_name = n.spent_name)"""
_SEARCH_VIEWS = ("spent_detail", "prodt_keyword", "keyword_type")
ORACLES["keyword_match"] = statement(_SEARCH_VIEWS, "select * from hits", KEYWORDS, _SEARCH)
ORACLES["keyword_match_common"] = statement(
    _SEARCH_VIEWS,
    "select * from hits",
    KEYWORDS,
    _SEARCH.replace(
        "select distinct spent_name from spent_detail",
        "select distinct spent_name || ' ' || split_part(spent_name, ' ', 1) || ' paid' as spent_name from spent_detail",
    ),
)
_ANALYSED = "case token when 'blue' then 'red' else token end"
ORACLES["keyword_match_analysed"] = statement(
    _SEARCH_VIEWS,
    "select * from hits",
    KEYWORDS,
    _SEARCH.replace("select spent_name, token, count(*)", f"select spent_name, {_ANALYSED} as token, count(*)")
    .replace("group by spent_name, token)", "and token <> 'ring' group by 1, 2)")
    .replace("select consume_keyword_id as keyword_id, token, count(*)", f"select consume_keyword_id as keyword_id, {_ANALYSED} as token, count(*)")
    .replace("group by consume_keyword_id, token)", "and token <> 'ring' group by 1, 2)"),
)


def _phrased(text: str) -> str:
    """Words of the text with the user dictionary's phrases replaced; the order here is that of the longest from the left."""
    made = f"lower({text})"
    for phrase, words in (("blue ring economy", "luxury ring"), ("blue ring", "bluering"), ("ring economy", "cheap"), ("old bolt", "scrap")):
        made = rf"regexp_replace({made}, '\b{phrase}\b', '{words}', 'g')"
    return made


ORACLES["phrase_tokens"] = statement(
    ("prodt_keyword", "keyword_type"),
    "select consume_keyword_id, " + _phrased("consume_keyword || ' ' || consume_keyword_type") + " as tokens from keywords",
    KEYWORDS,
)
ORACLES["keyword_match_phrases"] = statement(
    _SEARCH_VIEWS,
    "select * from hits",
    KEYWORDS,
    _SEARCH.replace(
        "select distinct spent_name from spent_detail", "select distinct spent_name || ' economy' as spent_name from spent_detail"
    )
    .replace("lower(spent_name)", _phrased("spent_name"))
    .replace("lower(consume_keyword)", _phrased("consume_keyword")),
)
ORACLES["separated_tokens"] = statement(
    ("keyword_type",),
    "select consume_keyword_type_id, part from (select consume_keyword_type_id, unnest(regexp_split_to_array("
    "replace(replace(consume_keyword_type, ' ', '|'), 'E', ','), '[,|]')) as part from keyword_type) p where part <> ''",
)
ORACLES["classify_spend"] = statement(_SEARCH_VIEWS, "select * from verdict", KEYWORDS, _SEARCH, _VERDICT)
ORACLES["reclassify_spent_detail"] = statement(
    _SEARCH_VIEWS,
    "select s.spent_idx, s.spent_name, v.consume_keyword_type_id from spent_detail s "
    "join verdict v on v.spent_name = s.spent_name",
    KEYWORDS,
    _SEARCH,
    _VERDICT,
)
ORACLES["reclassify_spent_detail_indexing"] = statement(
    (*SPEND_TABLES, "prodt_keyword"),
    "select s.spent_idx, s.spent_name, v.consume_keyword_type_id, v.consume_keyword_type from idx s "
    "join verdict v on v.spent_name = s.spent_name",
    INDEX,
    KEYWORDS,
    _SEARCH,
    _VERDICT,
)

# Amounts

_AMOUNTS = {
    "stock": (
        ("stock_asset", "stock", "stock_type"),
        "select a.user_seq, m.currency_code, sum(cast(a.stock_cnt as decimal(12,0)) * s.stock_price) as asset_sum "
        "from stock_asset a join stock s on s.stock_seq = a.stock_seq join stock_type m on m.market_seq = s.market_seq "
        "group by a.user_seq, m.currency_code having sum(s.stock_price) is not null",
    ),
    "crypto": (
        ("crypto_asset", "crypto", "currency_code"),
        "select a.user_seq, c.currency_code, sum(a.crypto_cnt * c.crypto_price) as asset_sum from crypto_asset a "
        "join crypto c on c.crypto_seq = a.crypto_seq join currency_code k on k.currency_code = c.currency_code "
        "group by a.user_seq, c.currency_code",
    ),
    "cash": (
        ("cash_asset",),
        "select user_seq, currency_code, sum(cash) as asset_sum from cash_asset group by user_seq, currency_code",
    ),
    "deposit": (
        ("deposit_asset",),
        "select user_seq, currency_code, sum(deposit_amount) as asset_sum from deposit_asset "
        "group by user_seq, currency_code",
    ),
    "saving": (
        ("saving_asset",),
        "select user_seq, currency_code, sum(accum_saving_amount) as asset_sum from saving_asset "
        "group by user_seq, currency_code",
    ),
}
for _kind, (_views, _sql) in _AMOUNTS.items():
    ORACLES[f"{_kind}_amount"] = statement(_views, _sql)
_SNAPSHOT = (
    f"select u.user_seq, m.currency_code, {NOW} as aggregated_at, "
    + ", ".join(f"coalesce({kind}.asset_sum, 0) as {kind}_amount" for kind in _AMOUNTS)
    + f", {NOW} as created_at, '{fixed.SNAPSHOT_USER}' as created_by "
    "from users u cross join (select distinct currency_code from stock_type) m "
    + " ".join(
        f"left join ({sql}) {kind} on {kind}.user_seq = u.user_seq and {kind}.currency_code = m.currency_code"
        for kind, (_, sql) in _AMOUNTS.items()
    )
)
_ASSET_VIEWS = ("users", *[view for views, _ in _AMOUNTS.values() for view in views])
ORACLES["asset_snapshot"] = statement(_ASSET_VIEWS, _SNAPSHOT)
ORACLES["asset_snapshot_append"] = statement(
    _ASSET_VIEWS,
    "select s.* replace (d.day as aggregated_at, d.day as created_at), cast(d.day as date) as snapshot_date from snapshot s "
    f"cross join (values ({EARLIER}), ({NOW})) d(day)",
    f"snapshot as ({_SNAPSHOT})",
)

# Prices

_STOCK_STAMPS = (
    f"case when f.stock_seq is not null then {NOW} end as updated_at, "
    "case when f.stock_seq is not null then 'batch' end as updated_by"
)
ORACLES["stock_price_update"] = statement(
    ("stock", "stock_type"),
    "select s.stock_seq, s.market_seq, s.stock_name, s.api_symbol, coalesce(f.new_price, s.stock_price) as stock_price, "
    f"{_STOCK_STAMPS} from stock s left join fetched f on f.stock_seq = s.stock_seq",
    _MARKET_STOCK,
)
ORACLES["stock_price_refetched"] = statement(
    ("stock", "stock_type"),
    "select s.stock_seq, s.market_seq, s.stock_name, s.api_symbol, coalesce(f.new_price + case when f.stock_seq % 5 = 0 "
    f"then 1 else 0 end, s.stock_price)::decimal(18,4) as stock_price, {_STOCK_STAMPS} "
    "from stock s left join fetched f on f.stock_seq = s.stock_seq",
    _MARKET_STOCK,
)
_HISTORY = f"{NOW} as recorded_at, date '2024-02-01' as recorded_date"
ORACLES["stock_price_history"] = statement(
    ("stock", "stock_type"),
    f"select stock_seq, api_symbol as symbol, currency_code, stock_name, cast(new_price as double) as price, {_HISTORY} "
    "from fetched",
    _MARKET_STOCK,
)
_COIN = "cast(crypto_price + 0.5 as decimal(18,4))"
ORACLES["crypto_price_update"] = statement(
    ("crypto",),
    "select crypto_seq, crypto_name, api_symbol, "
    f"case when currency_code <> 'EUR' then {_COIN} else crypto_price end as crypto_price, currency_code, "
    f"case when currency_code <> 'EUR' then {NOW} end as updated_at, "
    "case when currency_code <> 'EUR' then 'batch' end as updated_by from crypto",
)
ORACLES["crypto_price_history"] = statement(
    ("crypto",),
    f"select crypto_seq, api_symbol as symbol, currency_code, crypto_name, cast({_COIN} as double) as price, {_HISTORY} "
    "from crypto where currency_code <> 'EUR'",
)
_RATE_FETCHED = "is_active and base_currency_code <> 'CNY'"
ORACLES["fx_rate_update"] = statement(
    ("currency_exchange_rate_snapshot",),
    "select exchange_rate_snapshot_seq, base_currency_code, target_currency_code, "
    f"case when {_RATE_FETCHED} then cast({_RATE} as decimal(18,8)) else exchange_rate end as exchange_rate, is_active, "
    f"case when {_RATE_FETCHED} then {NOW} end as updated_at, case when {_RATE_FETCHED} then 'batch' end as updated_by "
    "from currency_exchange_rate_snapshot",
)

# Reports

ORACLES["group_range_agg"] = statement(
    SPEND_TABLES,
    "select g.agg_group_seq, cast(coalesce(sum(i.spent_money), 0) as bigint) as total_money, "
    "count(i.spent_idx) as spend_count from agg_group g left join idx i on i.agg_group_seq = g.agg_group_seq "
    f"and i.spent_at between {MONTH_START} and {MONTH_END} group by g.agg_group_seq",
    INDEX,
)


def _shares(start: str, end: str) -> str:
    return f"""cost as (
  select agg_group_seq, consume_keyword_type as spent_type, cast(sum(spent_money) as bigint) as spent_cost
  from idx where spent_at between {start} and {end} group by agg_group_seq, consume_keyword_type),
net as (select agg_group_seq, sum(spent_cost) as total from cost group by agg_group_seq),
shares as (
  select c.agg_group_seq, c.spent_type, c.spent_cost,
    round(cast(c.spent_cost as double) / nullif(cast(n.total as double), 0) * 100 * 10) / 10 as spent_per,
    cast(row_number() over (partition by c.agg_group_seq order by c.spent_cost desc, c.spent_type) as int) as rank_no
  from cost c join net n on n.agg_group_seq = c.agg_group_seq where c.spent_cost > 0)"""


def _detail(start: str, end: str, limit: int | None = fixed.DETAIL_ROWS_PER_REPORT) -> str:
    first = "" if limit is None else f" where row_no <= {limit}"
    return f"""detail as (
  select * from (select agg_group_seq, spent_idx, spent_at, spent_name, spent_money, consume_keyword_type, card_alias,
    cast(row_number() over (partition by agg_group_seq order by spent_at, spent_idx) as int) as row_no
    from idx where spent_at between {start} and {end}) d{first})"""


def _day(moment: str) -> str:
    return f"year({moment}) || '년 ' || month({moment}) || '월 ' || day({moment}) || '일'"


def _report(title: str, start: str, before: str) -> str:
    percent = "printf('%.1f%%', round(cast(total - prev_total as double) / cast(prev_total as double) * 1000) / 10)"
    return f"""sums as (
  select agg_group_seq,
    cast(sum(case when spent_at between {start} and {MONTH_END} then spent_money end) as bigint) as total,
    cast(sum(case when spent_at between {before} and {start} then spent_money end) as bigint) as prev_total,
    count(case when spent_at between {start} and {MONTH_END} then 1 end) as spend_count
  from idx where spent_at between {before} and {MONTH_END} group by agg_group_seq),
groups as (select agg_group_seq, count(*) as recipient_count from recipients group by agg_group_seq),
joined as (
  select g.agg_group_seq, g.recipient_count, coalesce(s.spend_count, 0) as spend_count,
    coalesce(s.total, 0) as total, coalesce(s.prev_total, 0) as prev_total
  from groups g left join sums s on s.agg_group_seq = g.agg_group_seq),
report as (
  select *, case when prev_total = 0 then '-'
      when total > prev_total then '▲ +' || {percent} || ' (+' || format('{{:,}}', total - prev_total) || ' 원)'
      when total < prev_total then '▼ ' || {percent} || ' (-' || format('{{:,}}', prev_total - total) || ' 원)'
      else '━ 0.0% (0 원)' end as change_text,
    case when prev_total = 0 or total = prev_total then '{fixed.COLOR_SAME}'
      when total > prev_total then '{fixed.COLOR_UP}' else '{fixed.COLOR_DOWN}' end as change_color,
    '[{title}] ' || {_day(start)} || ' ~ ' || {_day(MONTH_END)} || ' {fixed.SUBJECT_TAIL}' as subject
  from joined)"""


_REPORT_VIEWS = (*SPEND_TABLES, "send_email_agg_group")
ORACLES["category_share"] = statement(SPEND_TABLES, "select * from shares", INDEX, _shares(MONTH_START, MONTH_END))
ORACLES["highest_spends"] = statement(
    SPEND_TABLES,
    "select * from (select agg_group_seq, spent_idx, spent_money, cast(row_number() over "
    "(partition by agg_group_seq order by spent_money desc, spent_idx) as int) as row_no from idx "
    "where spent_at between timestamp '1996-01-01 00:00:00' and timestamp '1996-12-31 23:59:59') r where row_no <= 25",
    INDEX,
)
ORACLES["report_detail"] = statement(SPEND_TABLES, "select * from detail", INDEX, _detail(MONTH_START, MONTH_END))
ORACLES["monthly_report"] = statement(
    _REPORT_VIEWS, "select * from report", INDEX, RECIPIENTS, _report(fixed.MONTHLY_TITLE, MONTH_START, MONTH_BEFORE)
)
ORACLES["weekly_report"] = statement(
    _REPORT_VIEWS, "select * from report", INDEX, RECIPIENTS, _report(fixed.WEEKLY_TITLE, WEEK_START, WEEK_BEFORE)
)
ORACLES["email_recipients"] = statement(
    ("send_email_agg_group",),
    "select agg_group_seq, email_id, cast(row_number() over (partition by agg_group_seq order by email_id) as int) as row_no "
    "from recipients",
    RECIPIENTS,
)


def _escaped(column: str) -> str:
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#39;")):
        column = f"replace({column}, '{plain}', '{escaped}')"
    return column


def _html_row(*cells: tuple[str, str]) -> str:
    return "'<tr>' || " + " || ".join(f"'{style}' || {content} || '</td>'" for style, content in cells) + " || '</tr>'"


def _won(column: str) -> str:
    return f"format('{{:,}}', {column}) || ' 원'"


_DETAIL_HTML = _html_row(
    (fixed.CELL, _escaped("spent_name")),
    (fixed.MONEY_CELL, _won("spent_money")),
    (fixed.CELL, _day("spent_at")),
    (fixed.CELL, _escaped("consume_keyword_type")),
    (fixed.CELL, _escaped("card_alias")),
)
_CATEGORY_HTML = _html_row(
    (fixed.CELL, _escaped("spent_type")),
    (fixed.MONEY_CELL, _won("spent_cost")),
    (fixed.MONEY_CELL, "printf('%.1f%%', spent_per)"),
)


def _empty(width: int, text: str) -> str:
    return fixed.EMPTY_ROW.replace("{{WIDTH}}", str(width)).replace("{{TEXT}}", text)


_SUMMARY = fixed.SUMMARY
for _name, _value in {
    "CURRENT": _won("r.total"),
    "PREVIOUS": f"case when r.prev_total = 0 then '-' else {_won('r.prev_total')} end",
    "COLOR": "r.change_color",
    "CHANGE": "r.change_text",
}.items():
    _SUMMARY = _SUMMARY.replace("{{" + _name + "}}", f"' || {_value} || '")


def _bodies(title: str, days: str, per_part: int) -> str:
    """``bodies``: the parts of each report, cut after so many rows of a kind."""
    return f"""detail_parts as (
  select agg_group_seq, cast((row_no - 1) // {per_part} as int) as part, string_agg({_DETAIL_HTML}, '' order by row_no) as html
  from detail group by 1, 2),
share_parts as (
  select agg_group_seq, cast((rank_no - 1) // {per_part} as int) as part, string_agg({_CATEGORY_HTML}, '' order by rank_no) as html
  from shares group by 1, 2),
parts as (
  select agg_group_seq, part from detail_parts union select agg_group_seq, part from share_parts
  union select agg_group_seq, 0 from report),
bodies as (
  select r.agg_group_seq, p.part, r.subject,
    '<html><body><h1>{title}</h1><p>{days}</p>{_SUMMARY}<table><tbody>' ||
    case when r.agg_group_seq in (select agg_group_seq from detail_parts) then coalesce(d.html, '')
      else '{_empty(5, fixed.NO_DETAIL_TEXT)}' end || '</tbody></table><table><tbody>' ||
    case when r.agg_group_seq in (select agg_group_seq from share_parts) then coalesce(c.html, '')
      else '{_empty(3, fixed.NO_CATEGORY_TEXT)}' end || '</tbody></table><p>' ||
    format('{{:,}}', r.total) || '</p></body></html>' as body
  from report r join parts p on p.agg_group_seq = r.agg_group_seq
  left join detail_parts d on d.agg_group_seq = r.agg_group_seq and d.part = p.part
  left join share_parts c on c.agg_group_seq = r.agg_group_seq and c.part = p.part)"""


_WEEKLY = (
    INDEX,
    RECIPIENTS,
    _report(fixed.WEEKLY_TITLE, WEEK_START, WEEK_BEFORE),
    _detail(WEEK_START, MONTH_END, None),
    _shares(WEEK_START, MONTH_END),
    _bodies(fixed.WEEKLY_TITLE, "2000.6.8 ~ 2000.6.15", 10_000),
)
ORACLES["report_body"] = statement(_REPORT_VIEWS, "select * from bodies", *_WEEKLY)
ORACLES["report_mails"] = statement(
    _REPORT_VIEWS, "select b.*, r.email_id from bodies b join recipients r on r.agg_group_seq = b.agg_group_seq", *_WEEKLY
)
ORACLES["report_body_monthly"] = statement(
    _REPORT_VIEWS,
    "select * from bodies",
    INDEX,
    RECIPIENTS,
    _report(fixed.MONTHLY_TITLE, MONTH_START, MONTH_BEFORE),
    _detail(MONTH_START, MONTH_END, None),
    _shares(MONTH_START, MONTH_END),
    _bodies(fixed.MONTHLY_TITLE, "2000.5.15 ~ 2000.6.15", 50),
)

# Change feed

_FEED_VIEWS = (*SPEND_TABLES, "cdc_event", "group_offset")
ORACLES["cdc_latest_action"] = statement(("cdc_event",), "select * from latest", LATEST)
ORACLES["cdc_final_action"] = statement(
    ("cdc_event",),
    "select spent_idx, case when first = 'I' and last = 'D' then 'noop' when first = 'I' then 'upsert_new' "
    "when last = 'D' then 'delete' else 'upsert_existing' end as final_action, last <> 'D' as is_upsert_required "
    "from (select distinct spent_idx, first_value(kind) over w as first, last_value(kind) over w as last from "
    "(select spent_idx, upper(indexing_type[1]) as kind, reg_at, msg_offset from cdc_event) e window w as "
    "(partition by spent_idx order by reg_at, msg_offset rows between unbounded preceding and unbounded following)) f",
)
_APPLIED = _STAMPS.format(touched=_UPSERTED, now=NOW) + f" where not {_DELETED}"
ORACLES["cdc_apply"] = statement(_FEED_VIEWS, _APPLIED, INDEX, LATEST)
ORACLES["cdc_stream_apply"] = ORACLES["cdc_apply"]
ORACLES["backfill_catch_up"] = statement(
    _FEED_VIEWS,
    _APPLIED,
    INDEX,
    LATEST.replace(
        "from cdc_event)",
        "from cdc_event where partition_offset >= coalesce((select o.committed_offset from group_offset o "
        "where o.group_name = 'ref' and o.partition_id = cdc_event.partition_id), 0))",
    ),
)
ORACLES["rebuild_index"] = ORACLES["backfill_catch_up"]
ORACLES["cdc_store_apply"] = ORACLES["cdc_apply"]
_POSITION = (
    "(select o.committed_offset from group_offset o where o.group_name = '{group}' and o.partition_id = cdc_event.partition_id)"
)
_BETWEEN = (
    f"partition_offset >= coalesce({_POSITION.format(group='catchup')}, 0) and partition_offset < {_POSITION.format(group='ref')}"
)
ORACLES["feed_lag"] = statement(
    ("cdc_event", "group_offset"),
    "select coalesce(r.partition_id, f.partition_id) as partition_id, coalesce(r.committed_offset, 0) as reference_offset, "
    "coalesce(f.place, 0) as catchup_offset, greatest(coalesce(r.committed_offset, 0) - coalesce(f.place, 0), 0) as lag "
    "from (select * from group_offset where group_name = 'ref') r full join "
    "(select partition_id, max(partition_offset) + 1 as place from cdc_event group by partition_id) f "
    "on r.partition_id = f.partition_id",
)
ORACLES["newest_events"] = statement(("cdc_event",), "select spent_idx, max(reg_at) as reg_at from cdc_event group by spent_idx")
ORACLES["replay_between_offsets"] = statement(("cdc_event", "group_offset"), f"{_EVENTS} where {_BETWEEN}")
ORACLES["bounded_catch_up"] = statement(
    _FEED_VIEWS, _APPLIED, INDEX, LATEST.replace("from cdc_event)", f"from cdc_event where {_BETWEEN})")
)
ORACLES["offsets_after_catch_up"] = statement(
    ("group_offset",),
    "select * from group_offset where group_name = 'ref' union all "
    "select 'catchup', partition_id, max(committed_offset) from group_offset group by partition_id",
)
ORACLES["cdc_bad_messages"] = statement(
    ("cdc_event",),
    'select partition_id as "partition", partition_offset as "offset" from cdc_event where partition_offset % 10 = 0',
)
ORACLES["reclassify_published"] = ORACLES["reclassify_spent_detail_indexing"]
