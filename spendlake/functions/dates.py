"""Report periods and calendar parts. The moment a job runs at is always an argument."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendlake.fixed import REPORT_HOUR


class Period(NamedTuple):
    """Both ends belong to the period."""

    start: Column
    end: Column

    def holds(self, moment: Column) -> Column:
        return (moment >= self.start) & (moment <= self.end)


class ReportPeriods(NamedTuple):
    current: Period
    previous: Period


def moment(value: datetime | str | Column) -> Column:
    """A literal wall-clock moment."""
    return (value if isinstance(value, Column) else F.lit(str(value))).cast("timestamp_ntz")


def minute_number(at: Column) -> Column:
    """Minutes of wall-clock time since 1970, the same in every session time zone."""
    return F.unix_date(at.cast("date")).cast("bigint") * 1440 + F.hour(at) * 60 + F.minute(at)


def _report_hour_of(day: Column) -> Column:
    return day.cast("timestamp_ntz") + F.expr(f"interval {REPORT_HOUR} hours")


def _a_month_before(at: Column) -> Column:
    return _report_hour_of(F.add_months(at.cast("date"), -1))


def _a_week_before(at: Column) -> Column:
    return _report_hour_of(F.date_sub(at.cast("date"), 7))


def _periods(as_of: datetime | str | Column, start_of) -> ReportPeriods:
    end = moment(as_of)
    start = start_of(end)
    return ReportPeriods(Period(start, end), Period(start_of(start), start))


def monthly_periods(as_of: datetime | str | Column) -> ReportPeriods:
    """From one month earlier (clamped to the month's end) at the report hour up to ``as_of``, and the one before."""
    return _periods(as_of, _a_month_before)


def weekly_periods(as_of: datetime | str | Column) -> ReportPeriods:
    """From seven days earlier at the report hour up to ``as_of``, and the one before."""
    return _periods(as_of, _a_week_before)


def calendar_parts(day: Column) -> dict[str, Column]:
    """The attribute columns of a calendar row that depend on its date alone."""
    dd = F.day(day)
    last = F.day(F.last_day(day))
    weekday = F.weekday(day)
    flag = lambda test: F.when(test, 1).otherwise(0)
    return {
        "yyyy": F.year(day),
        "mm": F.month(day),
        "dd": dd,
        "yyyymm": F.date_format(day, "yyyyMM"),
        "yyyymmdd": F.date_format(day, "yyyyMMdd"),
        "day_of_month": dd,
        "quarter_no": F.quarter(day),
        "half_no": F.when(F.month(day) <= 6, 1).otherwise(2),
        "weekday_no": weekday,
        "is_weekend": flag(weekday >= 5),
        "is_weekday": flag(weekday < 5),
        "is_month_start": flag(dd <= 4),
        "is_month_end": flag(dd >= last - 3),
        "remaining_days_in_month": last - dd,
    }
