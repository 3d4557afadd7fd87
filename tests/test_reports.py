from __future__ import annotations

import subprocess
import sys
from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from spendlake.functions import text
from spendlake.functions.dates import Period, minute_number, moment, monthly_periods, weekly_periods
from spendlake.plans import reports

INDEX = (
    "agg_group_seq bigint, spent_idx bigint, spent_at timestamp_ntz, spent_name string, spent_money bigint, "
    "consume_keyword_type string, card_alias string"
)


def january():
    return Period(moment("2024-01-01 00:00:00"), moment("2024-02-01 00:00:00"))


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def spend(group, key, when, money, kind="food", name="lunch", card="card"):
    return (group, key, datetime.fromisoformat(when), name, money, kind, card)


def index(spark, *spends):
    return spark.createDataFrame(list(spends), INDEX)


def recipients(spark, *groups):
    return spark.createDataFrame([(g, f"m{i}@x") for i, g in enumerate(groups)], "agg_group_seq bigint, email_id string")


@pytest.mark.parametrize(
    ("as_of", "start", "previous"),
    [
        ("2024-03-31 12:00:00", "2024-02-29 09:00:00", "2024-01-29 09:00:00"),
        ("2023-03-31 12:00:00", "2023-02-28 09:00:00", "2023-01-28 09:00:00"),
        ("2024-01-15 01:00:00", "2023-12-15 09:00:00", "2023-11-15 09:00:00"),
    ],
)
def test_monthly_periods(spark, as_of, start, previous):
    current, before = monthly_periods(as_of)
    assert value(spark, current.start) == datetime.fromisoformat(start)
    assert value(spark, before.start) == datetime.fromisoformat(previous)
    assert value(spark, before.end) == datetime.fromisoformat(start)


def test_weekly_periods(spark):
    current, before = weekly_periods("2024-03-03 23:00:00")
    assert value(spark, current.start) == datetime(2024, 2, 25, 9)
    assert value(spark, before.start) == datetime(2024, 2, 18, 9)


@pytest.mark.parametrize(("amount", "shown"), [(-100, "-100"), (0, "0"), (1000, "1,000"), (-1234567, "-1,234,567")])
def test_money(spark, amount, shown):
    assert value(spark, text.money_text(F.lit(amount).cast("bigint"))) == shown


@pytest.mark.parametrize(
    ("now", "before", "shown"),
    [
        (0, 0, "-"), (500, 0, "-"), (500, 500, "━ 0.0% (0 원)"), (1500, 1000, "▲ +50.0% (+500 원)"),
        (9995, 10000, "▼ -0.1% (-5 원)"), (9999, 10000, "▼ -0.0% (-1 원)"), (0, 1000, "▼ -100.0% (-1,000 원)"),
        (100, -1000, "▲ +-110.0% (+1,100 원)"),
    ],
)
def test_change_text(spark, now, before, shown):
    columns = [F.lit(v).cast("bigint") for v in (now, before)]
    assert value(spark, text.change_text(*columns)) == shown


def test_cells(spark):
    assert value(spark, text.cell_text(F.lit(""))) == "-"
    assert value(spark, text.cell_text(F.lit("<a href='x'>&\"</a>"))) == "&lt;a href=&#39;x&#39;&gt;&amp;&quot;&lt;/a&gt;"
    assert value(spark, text.date_text(F.lit("2024-03-05").cast("date"))) == "2024년 3월 5일"
    assert value(spark, text.separated_tokens(F.lit("a b,c|d"))) == ["a b", "c", "d"]


def test_share_rounds_half_up_and_hides_what_is_not_positive(spark):
    frame = index(
        spark,
        spend(1, 1, "2024-01-02", 245, "a"),
        spend(1, 2, "2024-01-02", 1755, "b"),
        spend(1, 3, "2024-01-02", -1000, "refund"),
        spend(2, 4, "2024-01-02", -5, "refund"),
        spend(3, 5, "2024-01-02", 10, "a"),
        spend(3, 6, "2024-01-02", -10, "refund"),
    )
    found = rows(reports.category_share(frame, january()), "agg_group_seq", "spent_type", "spent_per", "rank_no")
    # Shares are of the net total, refunds included; a net total of 0 has no share.
    assert found == [(1, "a", 24.5, 2), (1, "b", 175.5, 1), (3, "a", None, 1)]


def test_a_share_ending_in_half_a_tenth(spark):
    frame = index(spark, spend(1, 1, "2024-01-02", 1225, "a"), spend(1, 2, "2024-01-02", 8775, "b"))
    assert rows(reports.category_share(frame, january()), "spent_per") == [(12.3,), (87.8,)]


def test_a_spend_at_the_shared_moment_counts_in_both_periods(spark):
    periods = monthly_periods("2024-03-15 12:00:00")
    frame = index(spark, spend(1, 1, "2024-02-15 09:00:00", 100), spend(1, 2, "2024-02-15 08:59:59", 7))
    report = reports.spent_report(frame, recipients(spark, 1), periods, "t")
    assert rows(report, "total", "prev_total", "spend_count") == [(100, 107, 1)]


def test_groups_without_spend_get_a_report_with_the_empty_texts(spark):
    periods = monthly_periods("2024-03-15 12:00:00")
    frame = index(spark, spend(1, 1, "2024-03-01", 100))
    body = reports.report_body(frame, recipients(spark, 9, 9), periods, "월간")
    ((group, part, subject, html),) = rows(body)
    assert (group, part, subject) == (9, 0, "[월간] 2024년 2월 15일 ~ 2024년 3월 15일 소비 내역")
    assert "소비 내역이 없습니다." in html and "카테고리 데이터가 없습니다." in html and "{{" not in html


def test_body_lists_rows_in_order(spark):
    periods = monthly_periods("2024-03-15 12:00:00")
    frame = index(
        spark, spend(1, 3, "2024-03-03", 3, name="third"), spend(1, 1, "2024-03-01", 1, name="first & only", card=""),
        spend(1, 2, "2024-03-01", 2, "rent", name="second"),
    )
    html = rows(reports.report_body(frame, recipients(spark, 1), periods, "t"), "body")[0][0]
    places = [html.index(word) for word in ("first &amp; only", "second", "third", "66.7%", "33.3%")]
    assert places == sorted(places)
    assert ">-</td>" in html


def test_long_lists_continue_in_further_parts(spark):
    periods = monthly_periods("2024-03-15 12:00:00")
    frame = index(spark, *[spend(1, i, "2024-03-01", 10 - i, f"kind {i}", name=f"name {i}.") for i in range(5)])
    body = reports.report_body(frame, recipients(spark, 1), periods, "t", rows_per_part=2)
    found = rows(body, "part", "body")
    listed = {part: [k for k in range(5) if f">kind {k}</td>" in html.rsplit("<table>", 1)[1]] for part, html in found}
    assert listed == {0: [0, 1], 1: [2, 3], 2: [4]}
    named = {part: [k for k in range(5) if f">name {k}.</td>" in html] for part, html in found}
    assert named == listed
    assert not any("없습니다" in html for _, html in found)


def test_more_categories_than_spends_in_a_part(spark):
    periods = monthly_periods("2024-03-15 12:00:00")
    frame = index(spark, *[spend(1, i, "2024-03-01", 10 - i, f"kind {i}") for i in range(3)])
    body = reports.report_body(frame, recipients(spark, 1), periods, "t", limit=1, rows_per_part=2)
    found = dict(rows(body, "part", "body"))
    assert sorted(found) == [0, 1] and not any("없습니다" in html for html in found.values())


def test_rows_with_missing_cells_are_listed(spark):
    periods = monthly_periods("2024-03-15 12:00:00")
    frame = index(
        spark, spend(1, 1, "2024-03-01", 1, name="full"), spend(1, 2, "2024-03-01", 2, name=None),
        spend(1, 3, "2024-03-01", 3, name="cardless", card=None),
    )
    html = rows(reports.report_body(frame, recipients(spark, 1), periods, "t"), "body")[0][0]
    assert html.split("<tbody>")[2].count("<tr>") == 3 and html.count(">-</td>") >= 2


def test_detail_keeps_the_oldest_rows_of_a_big_group(spark):
    data = spark.range(3000).select(
        F.lit(1).cast("bigint").alias("agg_group_seq"),
        F.col("id").alias("spent_idx"),
        (F.lit("2024-01-20 00:00:00").cast("timestamp_ntz") - F.make_dt_interval(secs=F.col("id") % 1000)).alias(
            "spent_at"
        ),
        F.lit("n").alias("spent_name"),
        F.lit(1).cast("bigint").alias("spent_money"),
        F.lit("k").alias("consume_keyword_type"),
        F.lit("c").alias("card_alias"),
    )
    found = rows(reports.report_detail(data, january(), limit=50), "row_no", "spent_idx")
    order = sorted(range(3000), key=lambda i: (-(i % 1000), i))[:50]
    assert found == sorted(enumerate(order, start=1), key=repr)


def test_numbering_without_limit_is_that_of_the_whole_group(spark):
    data = spark.range(5000).selectExpr("id % 2 as agg_group_seq", "id as spent_idx", "(id * 7919) % 50 as money")
    found = reports._numbered(data, [F.col("money").desc(), F.col("spent_idx")]).collect()
    for group in (0, 1):
        own = sorted((row for row in found if row.agg_group_seq == group), key=lambda r: (-r.money, r.spent_idx))
        assert [row.row_no for row in own] == list(range(1, 2501))


def test_recipients_are_a_row_each(spark):
    frame = spark.range(500).select(
        F.when(F.col("id") < 490, 1).otherwise(2).cast("bigint").alias("agg_group_seq"),
        F.concat(F.lit("m"), F.col("id"), F.lit("@x")).alias("email_id"),
    )
    found = reports.email_recipients(frame).orderBy("agg_group_seq", "row_no").collect()
    assert [row.email_id for row in found[:490]] == sorted(f"m{i}@x" for i in range(490))
    assert [row.row_no for row in found] == [*range(1, 491), *range(1, 11)]


def test_every_address_gets_every_part_over_many_routes(spark, monkeypatch):
    monkeypatch.setattr(reports, "MAILS_PER_ROUTE", 10)
    given = spark.range(400).selectExpr("if(id < 390, 1, id % 3) as agg_group_seq", "concat('m', id) as email_id")
    given = given.unionByName(spark.createDataFrame([(1, "m0"), (None, "m1"), (7, "m2"), (1, None)], "agg_group_seq bigint, email_id string"))
    bodies = spark.createDataFrame(
        [(g, part, f"s{g}", f"b{g}.{part}") for g in (0, 1, 5) for part in (0, 1)], "agg_group_seq bigint, part int, subject string, body string"
    )
    mails = reports.report_mails(bodies, given)
    assert mails.columns == ["agg_group_seq", "email_id", "part", "subject", "body"]
    assert rows(mails) == rows(given.join(bodies, "agg_group_seq"))
    assert mails.groupBy(F.spark_partition_id()).count().count() > 2


def test_written_mails_hold_a_long_body_once_for_each_file(spark, tmp_path):
    given = spark.range(60).selectExpr("cast(1 as bigint) as agg_group_seq", "concat('m', id) as email_id")
    body = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda i: F.sha2(i.cast("string"), 256)), "")
    bodies = spark.range(1).select(F.lit(1).cast("bigint").alias("agg_group_seq"), F.lit(0).alias("part"), F.lit("s").alias("subject"), body.alias("body"))
    reports.report_mails(bodies, given).write.parquet(f"{tmp_path}/mails")
    assert spark.read.parquet(f"{tmp_path}/mails").filter(F.length("body") == 1_280_000).count() == 60
    assert sum(file.stat().st_size for file in (tmp_path / "mails").glob("*.parquet")) < 4 * 1_280_000


def test_parts_that_repeat_or_have_no_number_are_mailed_as_often_as_they_come(spark):
    given = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "c")], "agg_group_seq bigint, email_id string")
    bodies = spark.createDataFrame(
        [(1, 0, "s", "x"), (1, 0, "s", "x"), (1, None, "s", "y"), (1, 3, None, None), (2, None, "s", "z"), (None, 0, "s", "n")],
        "agg_group_seq bigint, part int, subject string, body string",
    )
    assert rows(reports.report_mails(bodies, given)) == rows(given.join(bodies, "agg_group_seq"))


def test_copies_of_a_long_body_are_not_held_at_once():
    # 1,000 routes take a body of 1 MB, 1 GB in all; the process has 640 MB.
    script = str(Path(__file__).with_name("long_mails.py"))
    done = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=300)
    assert done.stdout.split() == ["1000", "1000000000"], done.stdout[-2000:] + done.stderr[-2000:]


def test_rows_in_descending_order_of_a_chosen_field(spark):
    frame = index(spark, *[spend(1, i, "2024-01-02", money) for i, money in enumerate((5, 9, 9, 1))])
    found = reports.group_range_rows(frame, january(), 3, order_by="spent_money", ascending=False)
    assert rows(found, "row_no", "spent_idx") == [(1, 1), (2, 2), (3, 0)]


def test_a_range_on_another_field(spark):
    frame = index(spark, *[spend(1, i, "2024-01-02", money) for i, money in enumerate((5, 9, 10, 1))])
    found = reports.group_range_agg(frame, Period(F.lit(5), F.lit(9)), range_field="spent_money")
    assert rows(found) == [(1, 14, 2)]


def test_minute_number_follows_the_wall_clock_in_every_zone(spark):
    # 02:30 does not exist in this zone on this day; as wall-clock time it is before 03:00.
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        early, late = (value(spark, minute_number(moment(f"2024-03-10 {t}:59"))) for t in ("02:30", "03:00"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert late - early == 30
    assert value(spark, minute_number(moment("1970-01-02 00:01:00"))) == 1441
