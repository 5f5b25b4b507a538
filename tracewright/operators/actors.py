"""Actor behaviour and concentration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import percent
from ..functions.timestamps import seconds_between
from .facts import ALL, distinct_of, rows_of, value_facts, with_totals
from .topk import top_per_group, value_counts


def whole_days(first: str, last: str) -> Column:
    """Full days between two times."""
    return F.floor(seconds_between(F.col(first), F.col(last)) / 86400).cast("bigint")


# What the distinct counts per actor are made of.
ACTOR_FACTS = {"case": ("actor", "case_id"), "field": ("actor", "field"), ALL: (None, "case_id")}


def actor_behavior(events: DataFrame) -> DataFrame:
    """Rows, cases, fields and active span per actor. Rows without actor form a group."""
    return behavior_of(value_facts(events, ACTOR_FACTS, ("first", "last")))


def behavior_of(facts: DataFrame) -> DataFrame:
    """``actor_behavior`` from the facts of the actors."""
    actors = facts.groupBy(F.col("key").alias("actor")).agg(
        rows_of("case").alias("event_count"),
        distinct_of("case").alias("cases_handled"),
        distinct_of("field").alias("unique_fields_modified"),
        F.min(F.when(F.col("kind") != ALL, F.col("first"))).alias("first_activity"),
        F.max(F.when(F.col("kind") != ALL, F.col("last"))).alias("last_activity"),
    ).where(F.col("event_count").isNotNull())
    return with_totals(actors, facts).select(
        "actor",
        "event_count",
        percent(F.col("event_count"), F.col("_all.rows")).alias("percentage_of_events"),
        "cases_handled",
        percent(F.col("cases_handled"), F.col("_all.cases")).alias("percentage_of_cases"),
        "unique_fields_modified", "first_activity", "last_activity",
        whole_days("first_activity", "last_activity").alias("activity_span_days"),
    )


def actor_operations(events: DataFrame) -> DataFrame:
    """Rows per actor and operation."""
    return value_counts(events, ["actor", "operation"], nulls=False)


def actor_top_fields(events: DataFrame, k: int = 5) -> DataFrame:
    """The most frequent fields per actor."""
    return top_per_group(value_counts(events, ["actor", "field"], nulls=False), ["actor"], ["field"], k)


def actor_concentration(events: DataFrame) -> DataFrame:
    """Share of the busiest and of the three busiest actors, and how many there are."""
    return concentration_of(value_counts(events, ["actor"]))


def concentration_of(counts: DataFrame) -> DataFrame:
    """``actor_concentration`` from the rows per actor."""
    three = counts.orderBy(F.desc("count"), "actor").limit(3).agg(F.sum("count"))
    sums = counts.agg(
        F.sum("count").alias("rows"), F.max("count").alias("top"), F.count("*").alias("actors")
    ).withColumn("three", three.scalar())
    return sums.select(
        percent(F.col("top"), F.col("rows")).alias("top_1_actor_pct"),
        percent(F.col("three"), F.col("rows")).alias("top_3_actors_pct"),
        F.col("actors").alias("total_actors"),
    )
