"""Field characteristics and the bucket they suggest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import percent
from ..functions.text import contains_any, trimmed
from . import fields
from .facts import count_of, distinct_of, rows_of, value_facts, with_totals

# Words in a field name that point to a bucket.
KILL_WORDS = (
    "discount", "base", "currency", "exchange", "price",
    "calculation", "error", "skip", "total",
)
STAGE_WORDS = (
    "stepname", "stage", "state", "status", "forecast",
    "processid", "closedate", "probability",
)
MILESTONE_WORDS = (
    "identify", "confirm", "develop", "present", "complete",
    "capture", "resolve", "file", "pursuit", "decision",
    "evaluate", "proposal", "feedback", "review", "debrief",
    "purchase", "contract", "opportunity", "revenue", "type",
    "influenced", "adx_", "gdpr", "ordertype", "rating",
)
ADMIN_WORDS = (
    "owner", "customer", "parent", "account", "contact",
    "businessunit", "workflow", "participant",
)
# Coverage in per cent and row counts that decide.
KILL_BELOW_PCT = 40
MILESTONE_MORE_THAN = 5
ADMIN_ABOVE_PCT = 20
ADMIN_MORE_THAN = 50


def field_characteristics(events: DataFrame, *, count_empty: bool = True) -> DataFrame:
    """Rows, case coverage, distinct values and blank old values per field.

    count_empty: count an empty text as a distinct value.
    """

    counted = None if count_empty else F.col("value") != ""
    facts = value_facts(events, fields.FIELD_FACTS)
    found = facts.groupBy(F.col("key").alias("field")).agg(
        rows_of("case").alias("total_occurrences"),
        distinct_of("case").alias("cases_affected"),
        distinct_of("new", counted).alias("unique_new_values"),
        distinct_of("old", counted).alias("unique_old_values"),
        count_of("old", trimmed(F.coalesce("value", F.lit(""))) == "").alias("_blank"),
    ).where(F.col("total_occurrences").isNotNull())
    rows = F.col("total_occurrences")
    return with_totals(found, facts).select(
        "field", "total_occurrences", "cases_affected",
        percent(F.col("cases_affected"), F.col("_all.cases")).alias("case_coverage_pct"),
        "unique_new_values", "unique_old_values",
        percent(F.col("_blank"), rows).alias("empty_old_pct"),
    )


def suggested_bucket() -> Column:
    """The rules in order; a rule whose guard fails passes the field on."""
    name, rows, coverage = F.col("field"), F.col("total_occurrences"), F.col("case_coverage_pct")
    return (
        F.when(contains_any(name, KILL_WORDS) & (coverage < KILL_BELOW_PCT), "KILL_NOISE")
        .when(contains_any(name, STAGE_WORDS), "L1_STAGE")
        .when(contains_any(name, MILESTONE_WORDS) & (rows > MILESTONE_MORE_THAN), "L2_MILESTONE")
        .when(contains_any(name, ADMIN_WORDS), "L3_ADMIN")
        .when((coverage > ADMIN_ABOVE_PCT) | (rows > ADMIN_MORE_THAN), "L3_ADMIN")
        .otherwise("UNKNOWN")
    )


def bucket_suggestions(events: DataFrame, **options: bool) -> DataFrame:
    """Field characteristics with the suggested bucket."""
    found = field_characteristics(events, **options)
    return found.withColumn("suggested_bucket", suggested_bucket())


def characteristic_values(events: DataFrame, k: int = 5) -> DataFrame:
    """Per field all operations and the k most frequent new values, by rows."""
    every = {
        "operation": fields.field_operations(events).withColumnRenamed("operation", "value"),
        "new_value": fields.field_top_values(events, k).drop("rank").withColumnRenamed("new_value", "value"),
    }
    parts = [part.select("field", F.lit(kind).alias("kind"), "value", "count") for kind, part in every.items()]
    order = Window.partitionBy("field", "kind").orderBy(F.desc("count"), "value")
    return parts[0].unionByName(parts[1]).withColumn("rank", F.row_number().over(order).cast("bigint"))


def suggested_fields(suggestions: DataFrame) -> DataFrame:
    """The fields of each suggested bucket with their place, most rows first."""
    order = Window.partitionBy("suggested_bucket").orderBy(F.desc("total_occurrences"), "field")
    return suggestions.select(
        "suggested_bucket", F.row_number().over(order).cast("bigint").alias("place"),
        "field", "total_occurrences", "case_coverage_pct", "cases_affected",
    ).orderBy("suggested_bucket", "place")


def suggested_counts(suggestions: DataFrame) -> DataFrame:
    """Fields per suggested bucket."""
    return suggestions.groupBy("suggested_bucket").agg(F.count("*").alias("fields"))
