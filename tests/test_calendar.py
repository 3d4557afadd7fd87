from __future__ import annotations

from datetime import date

from conftest import rows

from spendlake.plans.calendar import dim_calendar, year_range

HOLIDAYS = [(date(2024, 1, 1),), (date(2025, 12, 25),), (date(2026, 1, 1),)]


def calendar(spark):
    years = year_range(spark, 2024, 2025)
    return dim_calendar(years, spark.createDataFrame(HOLIDAYS, "dt date"), "2024-01-01 00:00:00")


def day(spark, text, *columns):
    return rows(calendar(spark).filter(f"dt = '{text}'"), *columns)[0]


def test_one_row_per_day(spark):
    frame = calendar(spark)
    assert frame.count() == 366 + 365
    assert frame.select("dt").distinct().count() == 366 + 365


def test_holiday_flags_at_the_edges(spark):
    flags = ("is_holiday", "is_before_holiday", "is_after_holiday")
    assert day(spark, "2024-01-01", *flags) == (1, 0, 0)
    assert day(spark, "2024-01-02", *flags) == (0, 0, 1)
    assert day(spark, "2025-12-24", *flags) == (0, 1, 0)
    # The given holidays reach past the range: the last day sees the next year's.
    assert day(spark, "2025-12-31", *flags) == (0, 1, 0)


def test_month_parts(spark):
    parts = ("is_month_start", "is_month_end", "remaining_days_in_month", "quarter_no", "half_no")
    assert day(spark, "2024-02-29", *parts) == (0, 1, 0, 1, 1)
    assert [day(spark, f"2025-02-{dd}", *parts)[1] for dd in (24, 25, 28)] == [0, 1, 1]
    assert day(spark, "2025-07-04", *parts) == (1, 0, 27, 3, 2)
    assert day(spark, "2025-07-05", *parts)[0] == 0


def test_weekdays(spark):
    assert day(spark, "2024-01-01", "weekday_no", "is_weekend", "is_weekday") == (0, 0, 1)
    assert day(spark, "2024-01-07", "weekday_no", "is_weekend", "is_weekday") == (6, 1, 0)


def test_texts(spark):
    assert day(spark, "2024-03-05", "yyyymm", "yyyymmdd") == ("202403", "20240305")
