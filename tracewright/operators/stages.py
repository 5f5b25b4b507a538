"""Stage order, stage regressions and value transitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import percent
from .fields import PREFIX
from .skew import LARGE_GROUP_ROWS, first_per_key, with_previous
from .topk import top_per_group

# Fields whose value changes are tracked.
TRANSITION_FIELDS = (
    "stepname", "statuscode", "statecode", "msdyn_forecastcategory", "the000g_revenuetype",
)


def stage_rows(events: DataFrame, field: str = "stepname") -> DataFrame:
    """Rows of the stage field with prefix (a number or null) and stage label."""
    prefix = F.regexp_extract("new_value", r"^(\d+)-", 1).try_cast("bigint")
    return events.where(F.col("field") == field).withColumns(
        {"prefix": prefix, "stage": F.regexp_replace("new_value", PREFIX, "")}
    )


def stage_order(events: DataFrame) -> DataFrame:
    """Per prefix the label of its first row, by case and time, and its row count."""
    rows = stage_rows(events).select("prefix", "stage", "case_id", "ts", "ingest_ord")
    numbered = rows.where(F.col("prefix").isNotNull())
    # One row per prefix and task is sorted out before the shuffle; counts are hashed.
    first = first_per_key(numbered, ["prefix"], ["case_id", "ts", "ingest_ord"]).select("prefix", "stage")
    counts = numbered.groupBy(F.col("prefix").alias("_prefix")).agg(F.count("*").alias("count"))
    return first.join(counts, F.col("prefix") == F.col("_prefix")).drop("_prefix")


def stepname_totals(events: DataFrame) -> DataFrame:
    """Rows, cases and prefixed rows of the stage field."""
    totals = stage_rows(events).agg(
        F.count("*").alias("total_stepname_changes"),
        F.countDistinct("case_id").alias("cases_with_stepname"),
        F.count("prefix").alias("prefix_coverage_count"),
    )
    share = percent(F.col("prefix_coverage_count"), F.col("total_stepname_changes"))
    return totals.withColumn("prefix_coverage_pct", share)


def stage_violations(
    events: DataFrame, limit: int = LARGE_GROUP_ROWS, counted: DataFrame | None = None
) -> DataFrame:
    """Steps back: prefix lower than the case's previous prefix, in time order.

    Rows without prefix are left out first, so both labels belong to the step.
    counted: rows to size the cases by, where ``events`` are costly to make.
    """
    numbered = stage_rows(events).where(F.col("prefix").isNotNull())
    rows = numbered.select("case_id", "ts", "ingest_ord", "prefix", "new_value")
    sized = None if counted is None else counted.where(F.col("field") == "stepname")
    steps = with_previous(
        rows, ["case_id"], ["ts", "ingest_ord"], ["prefix", "new_value"],
        limit=limit, counted=sized,
    )
    return steps.where(F.col("prefix") < F.col("previous.prefix")).select(
        "case_id", "ts", "ingest_ord",
        F.col("previous.new_value").alias("from_stage"),
        F.col("new_value").alias("to_stage"),
    )


def violation_summary(violations: DataFrame) -> DataFrame:
    """Number of steps back and of cases with one."""
    return violations.agg(
        F.count("*").alias("violation_count"),
        F.countDistinct("case_id").alias("cases_affected"),
    )


def transition_counts(
    events: DataFrame,
    fields: Sequence[str] = TRANSITION_FIELDS,
    limit: int = LARGE_GROUP_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """How often one value of a field follows another within a case."""
    tracked = F.col("field").isin(*fields)
    rows = events.where(tracked).select("field", "case_id", "ts", "ingest_ord", "new_value")
    sized = None if counted is None else counted.where(tracked)
    steps = with_previous(
        rows, ["field", "case_id"], ["ts", "ingest_ord"], ["new_value"],
        limit=limit, counted=sized,
    )
    followed = steps.where(F.col("previous").isNotNull())
    return followed.groupBy(
        "field",
        F.col("previous.new_value").alias("from_value"),
        F.col("new_value").alias("to_value"),
    ).agg(F.count("*").alias("count"))


def transition_totals(counts: DataFrame) -> DataFrame:
    """Transitions and distinct transitions per field."""
    return counts.groupBy("field").agg(
        F.sum("count").alias("total_transitions"),
        F.count("*").alias("unique_transitions"),
    )


def top_transitions(counts: DataFrame, k: int = 10) -> DataFrame:
    """The most frequent transitions per field."""
    return top_per_group(counts, ["field"], ["from_value", "to_value"], k)
