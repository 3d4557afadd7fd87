"""Calendar dimension with holiday flags."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.fixed import BATCH_USER
from spendlake.functions.dates import calendar_parts, moment

FLAGS = ("is_holiday", "is_before_holiday", "is_after_holiday")


def year_days(years: DataFrame) -> DataFrame:
    """Every date of the years; ``years`` is one row ``(start_year, end_year)``."""
    days = F.sequence(F.make_date("start_year", F.lit(1), F.lit(1)), F.make_date("end_year", F.lit(12), F.lit(31)))
    return years.select(F.explode(days).alias("dt"))


def dim_calendar(years: DataFrame, holidays: DataFrame, now: datetime | str) -> DataFrame:
    """Calendar rows of whole years. Flags look at the given holidays only, also at the range's edges.

    The three memberships are one aggregate: each holiday marks its own day, the day
    before and the day after, and the calendar's days join the marks once.
    """
    marks = holidays.select(
        F.explode(
            F.array(
                _mark(F.col("dt"), "is_holiday"),
                _mark(F.date_sub("dt", 1), "is_before_holiday"),
                _mark(F.date_add("dt", 1), "is_after_holiday"),
            )
        ).alias("mark")
    )
    flags = marks.groupBy(F.col("mark.dt").alias("dt")).agg(
        *[F.max(F.when(F.col("mark.kind") == flag, 1).otherwise(0)).alias(flag) for flag in FLAGS]
    )
    days = year_days(years).join(flags, "dt", "left")
    columns = [column.cast("int").alias(name) if not name.startswith("yyyym") else column.alias(name)
               for name, column in calendar_parts(F.col("dt")).items()]
    return days.select(
        "dt",
        *columns,
        *[F.coalesce(flag, F.lit(0)).alias(flag) for flag in FLAGS],
        moment(now).alias("created_at"),
        F.lit(BATCH_USER).alias("created_by"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        F.lit(None).cast("string").alias("updated_by"),
    )


def _mark(day: Column, kind: str) -> Column:
    return F.struct(day.alias("dt"), F.lit(kind).alias("kind"))


def year_range(spark: SparkSession, start_year: int, end_year: int) -> DataFrame:
    return spark.createDataFrame([(start_year, end_year)], "start_year int, end_year int")
