"""Case lifecycle: one row per case and what follows from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import rounded
from ..functions.timestamps import seconds_between
from .facts import TIMES, count_of, distinct_of, rows_of, value_facts
from .ordering import CREATE

# Fields whose presence is flagged and fields whose rows are counted.
PRESENCE_FIELDS = ("stepname", "statuscode", "statecode", "estimatedclosedate", "actualclosedate")
CHANGE_COUNTS = {
    "stepname_count": "stepname",
    "owner_changes": "ownerid",
    "revenue_type_changes": "the000g_revenuetype",
    "forecast_changes": "msdyn_forecastcategory",
}
# Size bands with their largest size.
SIZE_BANDS = (("1_event", 1), ("2_5_events", 5), ("6_10_events", 10), ("11_plus_events", None))


# What the distinct counts per case are made of.
CASE_FACTS = {"field": ("case_id", "field"), "actor": ("case_id", "actor")}


def case_metrics(events: DataFrame, *, create: str = CREATE, **options: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Size, breadth, duration and watched fields of every case. options: presence, changes."""
    return metrics_of(value_facts(events, CASE_FACTS, TIMES, create), **options)


def metrics_of(
    facts: DataFrame,
    *,
    presence: Sequence[str] = PRESENCE_FIELDS,
    changes: Mapping[str, str] = CHANGE_COUNTS,
) -> DataFrame:
    """``case_metrics`` from the facts of the cases."""
    cases = facts.groupBy(F.col("key").alias("case_id")).agg(
        rows_of("field").alias("event_count"),
        distinct_of("field").alias("unique_fields"),
        distinct_of("actor").alias("unique_actors"),
        F.min("first").alias("first_timestamp"),
        F.max("last").alias("last_timestamp"),
        F.min("created").alias("create_timestamp"),
        *[count_of("field", F.col("value") == name).alias(f"_rows_{name}") for name in presence],
        *[count_of("field", F.col("value") == name).alias(label) for label, name in changes.items()],
    )
    seconds = seconds_between(F.col("first_timestamp"), F.col("last_timestamp"))
    return cases.select(
        "case_id", "event_count", "unique_fields", "unique_actors",
        "first_timestamp", "last_timestamp",
        rounded(seconds / F.lit(86400.0)).alias("duration_days"),
        F.col("create_timestamp").isNotNull().alias("has_create_event"),
        "create_timestamp",
        *[(F.col(f"_rows_{name}") > 0).alias(f"has_{name}") for name in presence],
        *changes,
    )


def size_bands(cases: DataFrame, bands: Sequence[tuple] = SIZE_BANDS) -> DataFrame:
    """Cases per size band; empty bands count zero."""
    size, least, counts = F.col("event_count"), 0, []
    for name, most in bands:
        inside = size > least
        if most is not None:
            inside &= size <= most
        counts.append(F.count_if(inside).alias(name))
        least = most
    return cases.agg(*counts).unpivot([], [name for name, _ in bands], "band", "cases")


def duration_stats(cases: DataFrame) -> DataFrame:
    """Least, largest, mean and exact median of the rounded durations.

    The median counts distinct durations. They are hundredths of days, so their
    number follows the time span of the log and not the number of cases.
    """
    days = F.col("duration_days")
    return cases.agg(
        F.min(days).alias("min_days"),
        F.max(days).alias("max_days"),
        F.avg(days).alias("mean_days"),
        F.median(days).alias("median_days"),
        F.count_if(days == 0).alias("zero_duration_cases"),
    )


def field_presence(cases: DataFrame, presence: Sequence[str] = PRESENCE_FIELDS) -> DataFrame:
    """Cases that contain each watched field."""
    names = [f"has_{name}" for name in presence]
    counts = cases.agg(*[F.count_if(F.col(name)).alias(name) for name in names])
    return counts.unpivot([], names, "flag", "cases")
