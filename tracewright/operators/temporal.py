"""When changes happen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import percent

_DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
# Business hours, both ends included, and the first weekend day.
BUSINESS_HOURS = (9, 17)
WEEKEND_FROM = 5


def _count(events: DataFrame, condition: Column | None = None) -> Column:
    """How many rows, those of counted rows (column ``rows``) each as often as it says."""
    weight = F.col("rows") if "rows" in events.columns else F.lit(1)
    if condition is not None:
        weight = F.when(condition, weight).otherwise(0)
    return F.coalesce(F.sum(weight), F.lit(0)).cast("bigint")


def by_hour(events: DataFrame) -> DataFrame:
    """Rows per hour of the day."""
    return events.groupBy(F.hour("ts").alias("hour")).agg(_count(events).alias("count"))


def by_weekday(events: DataFrame) -> DataFrame:
    """Rows per day of the week."""
    days = events.groupBy(F.weekday("ts").alias("_day")).agg(_count(events).alias("count"))
    name = F.get(F.array(*[F.lit(day) for day in _DAYS]), F.col("_day"))
    return days.select(name.alias("day_name"), "count")


def by_month(events: DataFrame) -> DataFrame:
    """Rows per month of the year; months of different years fall together."""
    return events.groupBy(F.month("ts").alias("month")).agg(_count(events).alias("count"))


def daily_volume(events: DataFrame) -> DataFrame:
    """Mean, largest and smallest number of rows over the days that occur."""
    days = events.groupBy(F.to_date("ts").alias("date")).agg(_count(events).alias("count"))
    return days.agg(
        F.avg("count").alias("mean_per_day"),
        F.max("count").alias("max_per_day"),
        F.min("count").alias("min_per_day"),
    )


def activity_shares(
    events: DataFrame,
    business_hours: tuple[int, int] = BUSINESS_HOURS,
    weekend_from: int = WEEKEND_FROM,
) -> DataFrame:
    """Share of rows on weekends and within business hours."""
    counts = events.agg(
        _count(events).alias("rows"),
        _count(events, F.weekday("ts") >= weekend_from).alias("weekend"),
        _count(events, F.hour("ts").between(*business_hours)).alias("business"),
    )
    return counts.select(
        percent(F.col("weekend"), F.col("rows")).alias("weekend_activity_pct"),
        percent(F.col("business"), F.col("rows")).alias("business_hours_pct"),
    )
