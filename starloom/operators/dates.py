"""The calendar dimension."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The holidays every calendar row is checked against.
HOLIDAYS = {
    (1, 1): "New Year's Day",
    (7, 4): "Independence Day",
    (12, 25): "Christmas Day",
}


def date_key(day: Column | str) -> Column:
    """``yyyymmdd`` as a number."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def date_dim(
    spark: SparkSession,
    start: date = date(2010, 1, 1),
    end: date = date(2030, 12, 31),
    *,
    fiscal_start: int = 7,
    holidays: Mapping[tuple[int, int], str] = HOLIDAYS,
    full_date_type: str = "timestamp",
) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = spark.range(0, (end - start).days + 1, numPartitions=1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("day")
    )
    month, weekday = F.month("day"), F.dayofweek("day")
    holiday = F.lit(None).cast("string")
    for (m, d), title in holidays.items():
        holiday = F.when((month == m) & (F.dayofmonth("day") == d), F.lit(title)).otherwise(holiday)
    next_year = (month >= fiscal_start) & F.lit(fiscal_start > 1)
    return days.select(
        date_key("day").alias("date_key"),
        F.col("day").cast(full_date_type).alias("full_date"),
        F.year("day").alias("year"),
        F.quarter("day").alias("quarter"),
        month.alias("month"),
        F.date_format("day", "MMMM").alias("month_name"),
        F.dayofmonth("day").alias("day"),
        F.date_format("day", "EEEE").alias("day_name"),
        weekday.alias("day_of_week"),
        weekday.isin(1, 7).cast("int").alias("is_weekend"),
        holiday.isNotNull().cast("int").alias("is_holiday"),
        holiday.alias("holiday_name"),
        (F.year("day") + next_year.cast("int")).alias("fiscal_year"),
        (F.floor(((month + 12 - fiscal_start) % 12) / 3) + 1).cast("int").alias("fiscal_quarter"),
    )
