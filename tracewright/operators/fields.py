"""Field semantics: frequency, coverage and values of every field."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import percent, ratio
from .facts import ALL, count_of, distinct_of, rows_of, value_facts, with_totals
from .topk import top_per_group, value_counts

PREFIX = r"^\d+-"


# What the distinct counts per field are made of.
FIELD_FACTS = {
    "case": ("field", "case_id"), "old": ("field", "old_value"), "new": ("field", "new_value"), ALL: (None, "case_id"),
}


def field_semantics(events: DataFrame, prefix_field: str = "stepname") -> DataFrame:
    """Rows, cases, values and blanks per field. An empty value counts as a value."""
    return semantics_of(value_facts(events, FIELD_FACTS), prefix_field)


def semantics_of(facts: DataFrame, prefix_field: str = "stepname") -> DataFrame:
    """``field_semantics`` from the facts of the fields."""
    blank = F.col("value") == ""
    fields = facts.groupBy(F.col("key").alias("field")).agg(
        rows_of("case").alias("occurrence_count"),
        distinct_of("case").alias("cases_affected"),
        distinct_of("old").alias("unique_old_values"),
        distinct_of("new").alias("unique_new_values"),
        count_of("old", blank).alias("empty_old_count"),
        count_of("new", blank).alias("empty_new_count"),
        F.bool_or(F.when(F.col("kind") == "new", F.col("value").rlike(PREFIX))).alias("_prefixed"),
    ).where(F.col("occurrence_count").isNotNull())
    return with_totals(fields, facts).select(
        "field",
        "occurrence_count",
        percent(F.col("occurrence_count"), F.col("_all.rows")).alias("percentage_of_events"),
        "cases_affected",
        percent(F.col("cases_affected"), F.col("_all.cases")).alias("percentage_of_cases"),
        "unique_old_values", "unique_new_values", "empty_old_count", "empty_new_count",
        F.when(F.col("field") == prefix_field, F.col("_prefixed")).alias("has_prefix"),
    )


def field_operations(events: DataFrame) -> DataFrame:
    """Rows per field and operation."""
    return value_counts(events, ["field", "operation"], nulls=False)


def field_top_values(events: DataFrame, k: int = 5) -> DataFrame:
    """The most frequent new values per field."""
    counts = value_counts(events, ["field", "new_value"], nulls=False)
    return top_per_group(counts, ["field"], ["new_value"], k)


def field_coverage(events: DataFrame) -> DataFrame:
    """Share of cases per field and its band; rows without a field do not count."""
    known = events.where(F.col("field").isNotNull())
    return coverage_of(value_facts(known, {"case": ("field", "case_id"), ALL: (None, "case_id")}))


def coverage_of(facts: DataFrame) -> DataFrame:
    """``field_coverage`` from the facts of the rows that have a field."""
    cases = facts.groupBy(F.col("key").alias("field")).agg(
        rows_of("case").alias("_rows"), distinct_of("case").alias("cases")).where(F.col("_rows").isNotNull())
    share = ratio(F.col("cases"), F.col("_all.cases")) * 100
    band = (
        F.when(F.col("case_pct") > 50, "fields_above_50pct")
        .when(F.col("case_pct") > 25, "fields_25_to_50pct")
        .when(F.col("case_pct") > 10, "fields_10_to_25pct")
        .otherwise("fields_below_10pct")
    )
    shares = with_totals(cases, facts).select("field", "cases", share.alias("case_pct"))
    return shares.withColumn("band", band)
