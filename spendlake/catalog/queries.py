"""Every registered query: a function from the domain tables to a result frame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake import fixed
from spendlake.catalog import landed
from spendlake.functions import text
from spendlake.functions.dates import Period, moment, monthly_periods, weekly_periods
from spendlake.operators import amounts, cdc, classify, denormalise, merge, offsets, search
from spendlake.operators.publish import VersionedTable
from spendlake.operators.store import IndexStore
from spendlake.plans import calendar, prices, reports, snapshot, spend
from spendlake.schemas import schema_from_mapping
from spendlake.session import run_dir, stored
from spendlake.sources import feed, payloads
from spendlake.sources.tables import active_rows, lookup
from spendlake.sources.views import Domain
from spendlake.streaming import feed as stream
from spendlake.streaming import guard

NOW = datetime(2024, 2, 1)
EARLIER = datetime(2020, 1, 1)
AS_OF = datetime(2000, 6, 15, 12)

QUERIES: dict[str, Callable[[Domain], DataFrame]] = {}


def query(function: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _index(d: Domain) -> DataFrame:
    return denormalise.full_index(d)


def _recipients(d: Domain) -> DataFrame:
    return active_rows(d.send_email_agg_group).select("agg_group_seq", "email_id")


def _keywords(d: Domain) -> DataFrame:
    return denormalise.keywords_with_type(d.prodt_keyword, d.keyword_type)


def _names(d: Domain) -> DataFrame:
    return stored(d.spent_detail.select("spent_name").distinct(), "names")


def _keyed(d: Domain) -> DataFrame:
    """A keyed table for the write operators: the spends."""
    return d.spent_detail.select("spent_idx", "spent_name", "spent_money", "consume_keyword_type_id")


def _store(d: Domain, label: str) -> IndexStore:
    return IndexStore(d.spark, run_dir(d.spark, label), "spent_idx", sort_by=["spent_at"])


def _years(d: Domain) -> DataFrame:
    year = F.year("o_orderdate")
    return d.orders.agg(F.min(year).alias("start_year"), F.max(year).alias("end_year"))


# Sources


@query
def scan_spent_detail(d: Domain) -> DataFrame:
    return d.spent_detail


@query
def active_rates(d: Domain) -> DataFrame:
    return active_rows(d.currency_exchange_rate_snapshot).drop("is_active")


@query
def active_email_groups(d: Domain) -> DataFrame:
    return _recipients(d)


@query
def lookup_by_ids(d: Domain) -> DataFrame:
    return lookup(_keyed(d), d.cdc_event, "spent_idx")


@query
def cdc_source(d: Domain) -> DataFrame:
    folder = run_dir(d.spark, "cdc_source")
    stream.land_messages(feed.event_messages(d.cdc_event), f"{folder}/landed", files=6)
    messages = feed.read_feed_files(d.spark, f"{folder}/landed", files_per_batch=2)
    stream.copy_stream(messages, f"{folder}/pulled", f"{folder}/checkpoint")
    return feed.decode_events(d.spark.read.schema(feed.FEED_SCHEMA).parquet(f"{folder}/pulled"))


@query
def cdc_decode(d: Domain) -> DataFrame:
    return feed.decode_events(feed.event_messages(d.cdc_event))


@query
def holiday_dates(d: Domain) -> DataFrame:
    return payloads.holiday_dates(landed.holiday_documents(d))


@query
def quotes_domestic(d: Domain) -> DataFrame:
    return payloads.domestic_quotes(landed.stock_payloads(d).filter("currency_code <> 'USD'")).drop("currency_code")


@query
def quotes_overseas(d: Domain) -> DataFrame:
    return payloads.overseas_quotes(landed.stock_payloads(d).filter("currency_code = 'USD'")).drop("currency_code")


@query
def quotes_crypto(d: Domain) -> DataFrame:
    return payloads.crypto_prices(landed.crypto_payloads(d))


@query
def quotes_fx(d: Domain) -> DataFrame:
    return payloads.exchange_rates(landed.rate_payloads(active_rows(d.currency_exchange_rate_snapshot)))


# Writes


@query
def bulk_upsert(d: Domain) -> DataFrame:
    batch = d.cdc_event.select(
        "spent_idx",
        F.concat(F.lit("event "), "indexing_type").alias("spent_name"),
        (F.col("msg_offset") * 10).alias("spent_money"),
        F.lit(1).cast("bigint").alias("consume_keyword_type_id"),
        "msg_offset",
    )
    return merge.upsert(_keyed(d), batch, "spent_idx", order_by="msg_offset")


@query
def bulk_append(d: Domain) -> DataFrame:
    path = run_dir(d.spark, "bulk_append")
    rows = _keyed(d)
    merge.append_files(rows.filter("spent_money >= 0"), path, id_column="doc_id")
    merge.append_files(rows.filter("spent_money < 0"), path, id_column="doc_id")
    return d.spark.read.parquet(path).select(rows.columns)


@query
def bulk_partial_upsert(d: Domain) -> DataFrame:
    new_money = F.when(F.col("action") == "upsert", F.lit(7).cast("bigint"))
    batch = cdc.latest_action(d.cdc_event).select("spent_idx", new_money.alias("spent_money"))
    return merge.partial_upsert(_keyed(d), batch, "spent_idx")


@query
def bulk_delete(d: Domain) -> DataFrame:
    ids = cdc.latest_action(d.cdc_event).filter("action = 'delete'").select("spent_idx")
    return merge.delete(_keyed(d), ids.union(ids.select(-F.col("spent_idx") - 1)), "spent_idx")


@query
def bulk_case_update(d: Domain) -> DataFrame:
    new_type = F.lit(fixed.DEFAULT_TYPE_ID).cast("bigint").alias("consume_keyword_type_id")
    updates = cdc.latest_action(d.cdc_event).filter("action = 'upsert'").select("spent_idx", new_type)
    return merge.update_columns(_keyed(d), updates, "spent_idx")


@query
def spend_index_upsert(d: Domain) -> DataFrame:
    ids = cdc.latest_action(d.cdc_event).filter("action = 'upsert'")
    return merge.upsert_index_rows(_index(d), denormalise.spends_for_index(d, ids), "spent_idx", moment(NOW))


@query
def calendar_upsert(d: Domain) -> DataFrame:
    first_years = _years(d).select("start_year", (F.col("start_year") + 2).alias("end_year"))
    no_holidays = d.holiday.filter("false")
    existing = calendar.dim_calendar(first_years, no_holidays, EARLIER).withColumn("created_by", F.lit("seed"))
    rows = calendar.dim_calendar(_years(d), d.holiday, NOW)
    return merge.upsert_keeping_creation(existing, rows, "dt", moment(NOW))


@query
def publish_spent_detail(d: Domain) -> DataFrame:
    target = VersionedTable(d.spark, run_dir(d.spark, "publish"), "spent_detail")
    return spend.publish_full_index(_index(d), target, NOW, schema_from_mapping(fixed.INDEX_MAPPING))


@query
def produce_json(d: Domain) -> DataFrame:
    rows = d.spent_detail.select("spent_idx", "spent_name", "spent_money", "user_seq")
    return feed.to_messages(rows, F.col("spent_idx"))


@query
def copy_offsets(d: Domain) -> DataFrame:
    return cdc.copy_offsets(d.group_offset, "ref", "catchup")


# Joins


@query
def spent_detail_indexing(d: Domain) -> DataFrame:
    return denormalise.spends_for_index(d)


@query
def spent_type_keywords(d: Domain) -> DataFrame:
    target = VersionedTable(d.spark, run_dir(d.spark, "spent_type"), "spent_type")
    return spend.publish_keywords(d, target, NOW)


@query
def stock_with_market(d: Domain) -> DataFrame:
    return denormalise.stocks_with_market(d.stock, d.stock_type)


@query
def keyword_match(d: Domain) -> DataFrame:
    return search.keyword_match(_names(d), _keywords(d))


@query
def keyword_match_common(d: Domain) -> DataFrame:
    """Longer names, one word of theirs twice, with every token in more than two keywords taken as common."""
    first = F.substring_index("spent_name", " ", 1)
    names = d.spent_detail.select(F.concat("spent_name", F.lit(" "), first, F.lit(" paid")).alias("spent_name")).distinct()
    return search.keyword_match(names, _keywords(d), search.SearchOptions(posting_limit=2))


@query
def keyword_match_analysed(d: Domain) -> DataFrame:
    """Without a stop word, and with one token spelled as another."""
    synonyms = d.prodt_keyword.select(F.lit("blue").alias("token"), F.lit("red").alias("canonical")).distinct()
    names = d.spent_detail.select("spent_name").distinct()
    return search.keyword_match(names, _keywords(d), search.SearchOptions(stop_words=("ring",)), synonyms)


# Entries of a user dictionary, of two and three words.
PHRASES = {"blue ring": "bluering", "blue ring economy": "luxury ring", "ring economy": "cheap", "old bolt": "scrap"}


@query
def phrase_tokens(d: Domain) -> DataFrame:
    """Keywords and their types as the user dictionary reads them."""
    listed = text.tokens(F.concat("consume_keyword", F.lit(" "), "consume_keyword_type"))
    joined = F.array_join(text.joined_phrases(listed, PHRASES), " ")
    return _keywords(d).select("consume_keyword_id", joined.alias("tokens"))


@query
def keyword_match_phrases(d: Domain) -> DataFrame:
    """With runs of words that count as other words, in names and keywords."""
    names = d.spent_detail.select(F.concat("spent_name", F.lit(" economy")).alias("spent_name")).distinct()
    return search.keyword_match(names, _keywords(d), search.SearchOptions(phrases=PHRASES))


@query
def separated_tokens(d: Domain) -> DataFrame:
    """Parts of type names, written with bars and commas."""
    written = F.replace(F.replace("consume_keyword_type", F.lit(" "), F.lit("|")), F.lit("E"), F.lit(","))
    parts = F.explode(text.separated_tokens(written)).alias("part")
    return d.keyword_type.select("consume_keyword_type_id", parts)


@query
def consumer_lag(d: Domain) -> DataFrame:
    return cdc.lag_by_partition(d.group_offset, "ref", "catchup")


@query
def dim_calendar(d: Domain) -> DataFrame:
    return calendar.dim_calendar(_years(d), d.holiday, NOW)


# Aggregates


@query
def stock_amount(d: Domain) -> DataFrame:
    return amounts.amount_per_user(amounts.stock_rows(d.stock_asset, d.stock, d.stock_type))


@query
def crypto_amount(d: Domain) -> DataFrame:
    return amounts.amount_per_user(amounts.crypto_rows(d.crypto_asset, d.crypto, d.currency_code))


@query
def cash_amount(d: Domain) -> DataFrame:
    return amounts.amount_per_user(amounts.cash_rows(d.cash_asset))


@query
def deposit_amount(d: Domain) -> DataFrame:
    return amounts.amount_per_user(amounts.deposit_rows(d.deposit_asset))


@query
def saving_amount(d: Domain) -> DataFrame:
    return amounts.amount_per_user(amounts.saving_rows(d.saving_asset))


@query
def asset_snapshot(d: Domain) -> DataFrame:
    return snapshot.asset_snapshot(d, NOW)


@query
def asset_snapshot_append(d: Domain) -> DataFrame:
    path = run_dir(d.spark, "snapshots")
    for day in (EARLIER, NOW):
        snapshot.append_snapshot(snapshot.asset_snapshot(d, day), path)
    return d.spark.read.parquet(path)


@query
def group_range_agg(d: Domain) -> DataFrame:
    return reports.group_range_agg(_index(d), monthly_periods(AS_OF).current, d.agg_group)


@query
def category_share(d: Domain) -> DataFrame:
    return reports.category_share(_index(d), monthly_periods(AS_OF).current)


@query
def email_recipients(d: Domain) -> DataFrame:
    return reports.email_recipients(_recipients(d))


@query
def consumer_lag_total(d: Domain) -> DataFrame:
    return cdc.total_lag(d.group_offset, "ref", "catchup")


@query
def cdc_latest_action(d: Domain) -> DataFrame:
    return cdc.latest_action(d.cdc_event)


@query
def cdc_final_action(d: Domain) -> DataFrame:
    return cdc.final_action(d.cdc_event)


# Prices


def _stock_prices(d: Domain) -> DataFrame:
    stocks = denormalise.stocks_with_market(d.stock, d.stock_type)
    return prices.stock_prices(stocks, landed.stock_payloads(d).select("stock_seq", "payload"))


def _crypto_prices(d: Domain) -> DataFrame:
    return prices.crypto_prices(d.crypto, landed.crypto_payloads(d))


def _unstamped(table: DataFrame) -> DataFrame:
    return table.withColumns(
        {"updated_at": F.lit(None).cast("timestamp_ntz"), "updated_by": F.lit(None).cast("string")}
    )


@query
def stock_price_update(d: Domain) -> DataFrame:
    return prices.update_prices(_unstamped(d.stock), _stock_prices(d), "stock_seq", "stock_price", NOW)


@query
def stock_price_refetched(d: Domain) -> DataFrame:
    """Every fifth stock fetched twice: the price that landed last counts."""
    stocks = denormalise.stocks_with_market(d.stock, d.stock_type)
    fetched = landed.stock_payloads_twice(d).select("stock_seq", "payload", "landed_at")
    found = prices.stock_prices(stocks, fetched, order_by="landed_at")
    return prices.update_prices(_unstamped(d.stock), found, "stock_seq", "stock_price", NOW, order_by="landed_at")


@query
def crypto_price_update(d: Domain) -> DataFrame:
    return prices.update_prices(_unstamped(d.crypto), _crypto_prices(d), "crypto_seq", "crypto_price", NOW)


@query
def fx_rate_update(d: Domain) -> DataFrame:
    rates = _unstamped(d.currency_exchange_rate_snapshot)
    fetched = payloads.exchange_rates(landed.rate_payloads(active_rows(rates)))
    return prices.update_rates(rates, fetched, NOW)


@query
def stock_price_history(d: Domain) -> DataFrame:
    path = run_dir(d.spark, "stock_price_history")
    history = prices.price_history(_stock_prices(d), "stock_seq", "stock_name", NOW)
    prices.append_history(history, path)
    return d.spark.read.schema(history.schema).parquet(path)


@query
def crypto_price_history(d: Domain) -> DataFrame:
    path = run_dir(d.spark, "crypto_price_history")
    history = prices.price_history(_crypto_prices(d), "crypto_seq", "crypto_name", NOW)
    prices.append_history(history, path)
    return d.spark.read.schema(history.schema).parquet(path)


# Classifier


@query
def classify_spend(d: Domain) -> DataFrame:
    return classify.classify_names(_names(d), _keywords(d))


@query
def reclassify_spent_detail(d: Domain) -> DataFrame:
    return spend.reclassify_spends(d.spent_detail, _keywords(d)).select(
        "spent_idx", "spent_name", "consume_keyword_type_id"
    )


@query
def reclassify_spent_detail_indexing(d: Domain) -> DataFrame:
    return spend.reclassify_spends(_index(d), _keywords(d), with_type_name=True).select(
        "spent_idx", "spent_name", "consume_keyword_type_id", "consume_keyword_type"
    )


@query
def reclassify_published(d: Domain) -> DataFrame:
    """The reclassified index as the next published version."""
    target = VersionedTable(d.spark, run_dir(d.spark, "reclassified"), "spent_detail")
    spends = spend.reclassify_spends(_index(d), _keywords(d), with_type_name=True)
    return spend.publish_full_index(spends, target, NOW).select(
        "spent_idx", "spent_name", "consume_keyword_type_id", "consume_keyword_type"
    )


# Reports


@query
def report_detail(d: Domain) -> DataFrame:
    periods = monthly_periods(AS_OF)
    spends = stored(reports.report_rows(_index(d), periods), "report-rows")
    return reports.report_detail(spends, periods.current, fixed.DETAIL_ROWS_PER_REPORT)


@query
def highest_spends(d: Domain) -> DataFrame:
    """The 25 highest spends of each group in a year."""
    rows = stored(_index(d), "index")
    year = Period(moment("1996-01-01"), moment("1996-12-31 23:59:59"))
    found = reports.group_range_rows(rows, year, 25, order_by="spent_money", ascending=False)
    return found.select("agg_group_seq", "spent_idx", "spent_money", "row_no")


@query
def report_body(d: Domain) -> DataFrame:
    periods = weekly_periods(AS_OF)
    spends = stored(reports.report_rows(_index(d), periods), "report-rows")
    return reports.report_body(spends, _recipients(d), periods, fixed.WEEKLY_TITLE)


@query
def report_body_monthly(d: Domain) -> DataFrame:
    periods = monthly_periods(AS_OF)
    spends = stored(reports.report_rows(_index(d), periods), "report-rows")
    return reports.report_body(spends, _recipients(d), periods, fixed.MONTHLY_TITLE, rows_per_part=50)


@query
def report_mails(d: Domain) -> DataFrame:
    return reports.report_mails(report_body(d), _recipients(d))


@query
def monthly_report(d: Domain) -> DataFrame:
    return reports.spent_report(_index(d), _recipients(d), monthly_periods(AS_OF), fixed.MONTHLY_TITLE)


@query
def weekly_report(d: Domain) -> DataFrame:
    return reports.spent_report(_index(d), _recipients(d), weekly_periods(AS_OF), fixed.WEEKLY_TITLE)


# Change feed


@query
def cdc_apply(d: Domain) -> DataFrame:
    return cdc.apply_changes(_index(d), d.cdc_event, d, moment(NOW))


@query
def cdc_stream_apply(d: Domain) -> DataFrame:
    folder = run_dir(d.spark, "cdc_stream")
    stream.land_messages(feed.event_messages(d.cdc_event), f"{folder}/landed", files=6)
    messages = feed.read_feed_files(d.spark, f"{folder}/landed", files_per_batch=2)
    running = stream.start_feed(messages, lambda: d, f"{folder}/changes", f"{folder}/checkpoint", now=lambda: NOW)
    running.awaitTermination()
    changes = stream.read_change_log(d.spark, f"{folder}/changes")
    return stream.read_index(_index(d), changes, by_event_time=True)


@query
def backfill_catch_up(d: Domain) -> DataFrame:
    events = feed.decode_events(feed.event_messages(d.cdc_event))
    return spend.backfill_and_catch_up(d, events, d.group_offset, "ref", NOW)


@query
def rebuild_index(d: Domain) -> DataFrame:
    events = feed.decode_events(feed.event_messages(d.cdc_event))
    return spend.rebuild_index(d, events, d.group_offset, "catchup", "ref", _store(d, "rebuild"), NOW)


@query
def cdc_store_apply(d: Domain) -> DataFrame:
    """The feed in three batches, each folded into the files that hold its keys."""
    folder = run_dir(d.spark, "cdc_store")
    store = _store(d, "index-store")
    store.publish(_index(d), EARLIER)
    stream.land_messages(feed.event_messages(d.cdc_event), f"{folder}/landed", files=6)
    messages = feed.read_feed_files(d.spark, f"{folder}/landed", files_per_batch=2)
    running = stream.start_feed(messages, lambda: d, f"{folder}/changes", f"{folder}/checkpoint", now=lambda: NOW)
    running.awaitTermination()
    changes = stream.read_change_log(d.spark, f"{folder}/changes")
    for batch in range(stream.last_batch(changes) + 1):
        stream.compact(store, changes.filter(F.col("batch_id") <= batch), NOW, by_event_time=True)
    return stream.read_current(store, changes, by_event_time=True)


@query
def feed_lag(d: Domain) -> DataFrame:
    """How far the feed, once it has run, is behind the positions of a group."""
    folder = run_dir(d.spark, "feed_lag")
    stream.land_messages(feed.event_messages(d.cdc_event), f"{folder}/landed", files=6)
    messages = feed.read_feed_files(d.spark, f"{folder}/landed", files_per_batch=3)
    running = stream.start_feed(
        messages, lambda: d, f"{folder}/changes", f"{folder}/checkpoint", lambda: NOW, positions=f"{folder}/positions"
    )
    running.awaitTermination()
    both = d.group_offset.unionByName(stream.read_positions(d.spark, f"{folder}/positions"))
    return cdc.lag_by_partition(both, "ref", "feed")


@query
def newest_events(d: Domain) -> DataFrame:
    """Each key's newest event time after three micro-batches that the guard let through only what is newer."""
    folder = run_dir(d.spark, "newest_events")
    stream.land_messages(feed.event_messages(d.cdc_event), f"{folder}/landed", files=6)
    messages = feed.read_feed_files(d.spark, f"{folder}/landed", files_per_batch=2)
    passed = guard.newest_events(feed.decode_events(messages), forget_after="400 days")
    stream.copy_stream(passed, f"{folder}/passed", f"{folder}/checkpoint")
    return d.spark.read.schema(passed.schema).parquet(f"{folder}/passed").groupBy("spent_idx").agg(F.max("reg_at").alias("reg_at"))


@query
def replay_between_offsets(d: Domain) -> DataFrame:
    """Exactly the events between the positions of two groups."""
    start, end = (offsets.positions_of(d.group_offset, group) for group in ("catchup", "ref"))
    return feed.decode_events(feed.event_messages(d.cdc_event).filter(offsets.in_range(start, end)))


@query
def bounded_catch_up(d: Domain) -> DataFrame:
    """The index brought from one group's positions to another's in three bounded reads."""
    start, end = (offsets.positions_of(d.group_offset, group) for group in ("catchup", "ref"))
    store = _store(d, "bounded")
    store.publish(_index(d), EARLIER, positions=start)
    messages = feed.event_messages(d.cdc_event)
    lag = sum(max(0, stop - start.get(partition, 0)) for partition, stop in end.items())
    spend.catch_up(store, lambda a, b: messages.filter(offsets.in_range(a, b)), d, end, lag // 3 + 1, NOW)
    return store.read()


@query
def offsets_after_catch_up(d: Domain) -> DataFrame:
    """The offsets table with the positions that a bounded read of 1,000 messages commits."""
    start, end = (offsets.positions_of(d.group_offset, group) for group in ("catchup", "ref"))
    while (step := offsets.next_positions(start, end, 1000)) != start:
        start = step
    return offsets.with_positions(d.group_offset, "catchup", start)


@query
def cdc_bad_messages(d: Domain) -> DataFrame:
    """Messages that a decoder must set aside: every tenth event with a field taken away or cut short."""
    broken = F.when(F.col("offset") % 20 == 0, F.regexp_replace("value", '"reg_at"', '"seen_at"')).when(
        F.col("offset") % 10 == 0, F.substring("value", 1, 12)
    )
    messages = feed.event_messages(d.cdc_event).withColumn("value", F.coalesce(broken, F.col("value")))
    return feed.decode_events_with_quarantine(messages)[1].select("partition", "offset")
