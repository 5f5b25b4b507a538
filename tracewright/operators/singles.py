"""Cases with a single event, and creation patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import percent, ratio, rounded
from ..functions.text import clipped
from .facts import count_of
from .ordering import CREATE
from .skew import first_per_key
from .topk import value_counts


# Fields whose lone events hint at an abandoned item and at a bulk assignment.
ABANDONED_FIELD, ASSIGNED_FIELD = "the000g_revenuetype", "ownerid"


def single_fields(singles: DataFrame, sample_chars: int | None = None) -> DataFrame:
    """Rows per field, their share and the first row as a sample, cut to sample_chars."""
    first = first_per_key(singles, ["field"], ["case_id", "ts", "ingest_ord"]).where(F.col("field").isNotNull())
    counts = singles.groupBy(F.col("field").alias("_field")).agg(F.count("*").alias("count"))
    # Rows without a field count in the share.
    found = first.join(counts, F.col("field") == F.col("_field")).withColumn("_rows", counts.agg(F.sum("count")).scalar())
    return found.select(
        "field",
        "count",
        percent(F.col("count"), F.col("_rows")).alias("percentage_of_single_events"),
        clipped(F.col("new_value"), sample_chars, "...").alias("sample_value"),
        F.col("actor").alias("sample_actor"),
    )


def single_actors(singles: DataFrame) -> DataFrame:
    """Rows per actor."""
    return value_counts(singles, ["actor"], nulls=False)


def single_operations(singles: DataFrame) -> DataFrame:
    """Rows per operation."""
    return value_counts(singles, ["operation"], nulls=False)


def single_totals(
    singles: DataFrame,
    create: str = CREATE,
    abandoned: str = ABANDONED_FIELD,
    assigned: str = ASSIGNED_FIELD,
) -> DataFrame:
    """Counts over the single-event rows that the summary and the hypotheses share."""
    return singles.agg(
        F.count("*").alias("total_events"),
        F.count_if(F.col("operation") == create).alias("creation_count"),
        F.count_if(F.col("field") == abandoned).alias("revenue_rows"),
        F.count_if(F.col("field") == assigned).alias("owner_rows"),
        F.countDistinct("actor").alias("unique_actors"),
    )


def single_summary(events: DataFrame, singles: DataFrame, create: str = CREATE) -> DataFrame:
    """Totals, share of cases, creation counts and the busiest actor.

    The single-event rows are aggregated once, by actor; the rest follows from that.
    """
    created = F.count_if(F.col("operation") == create)
    by_actor = singles.groupBy("actor").agg(F.count("*").alias("rows"), created.alias("creates"))
    # Among equally busy actors the first by name counts.
    order = F.struct((-F.col("rows")).alias("rows"), "actor")
    busiest = F.min(F.when(F.col("actor").isNotNull(), order))
    totals = by_actor.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_events"),
        F.coalesce(F.sum("creates"), F.lit(0)).alias("creation_count"),
        F.count("actor").alias("unique_actors"),
        busiest.alias("_busiest"),
    )
    cases = events.agg(F.countDistinct("case_id")).scalar()
    total, creates = F.col("total_events"), F.col("creation_count")
    return totals.withColumn("_cases", cases).select(
        total.alias("total_cases"),
        percent(total, F.col("_cases")).alias("percentage_of_cases"),
        "total_events",
        ((creates > 0) & (creates == total)).alias("is_creation_driven"),
        "creation_count",
        (total - creates).alias("non_creation_count"),
        (-F.col("_busiest.rows")).alias("top_actor"),
        F.col("_busiest.actor").alias("top_actor_name"),
        "unique_actors",
    )


def bulk_dates(singles: DataFrame, more_than: int = 5) -> DataFrame:
    """Days with more single-event rows than the threshold."""
    days = singles.groupBy(F.to_date("ts").alias("date")).agg(F.count("*").alias("count"))
    return days.where(F.col("count") > more_than)


def hypotheses(singles: DataFrame, create: str = CREATE, **fields: str) -> DataFrame:
    """What the single-event cases may come from, as flags. fields: abandoned, assigned."""
    total, created = F.col("total_events"), F.col("creation_count")
    return single_totals(singles, create, **fields).select(
        ((F.col("revenue_rows") > 0) & (created == 0)).alias("abandoned_opportunities"),
        ((F.col("owner_rows") > 0) & (F.col("unique_actors") <= 2)).alias("bulk_assignment"),
        ((created > 0) & (created < total)).alias("incomplete_audit_trail"),
        ((created > 0) & (created == total)).alias("creation_only"),
    )


def single_samples(singles: DataFrame, n: int = 10, chars: int | None = None) -> DataFrame:
    """The first cases by id, values cut to chars."""
    return singles.orderBy("case_id").limit(n).select(
        "case_id", "operation", "field",
        clipped(F.col("new_value"), chars, "...").alias("new_value"),
        "actor", "ts",
    )


def latest_singles(singles: DataFrame, n: int = 10) -> DataFrame:
    """The latest single-event rows."""
    return singles.orderBy(F.desc("ts"), "case_id").limit(n)


def creation_summary(events: DataFrame, create: str = CREATE) -> DataFrame:
    """Create rows, cases with one, and rows per such case."""
    return _per_case(events.where(F.col("operation") == create).agg(
        F.count("*").alias("total_create_events"),
        F.countDistinct("case_id").alias("cases_with_create"),
    ))


def creation_of(fields: DataFrame, cases: DataFrame, create: str = CREATE) -> DataFrame:
    """``creation_summary`` from the facts of the fields and those of the cases."""
    rows = fields.agg(count_of("operation", F.col("value") == create)).scalar()
    found = cases.where(F.col("created").isNotNull()).agg(F.countDistinct("key").alias("cases_with_create"))
    return _per_case(found.select(rows.alias("total_create_events"), "cases_with_create"))


def _per_case(totals: DataFrame) -> DataFrame:
    rows, cases = F.col("total_create_events"), F.col("cases_with_create")
    return totals.withColumn("create_events_per_case", rounded(ratio(rows, cases)))


def creation_top(events: DataFrame, column: str, k: int, create: str = CREATE) -> DataFrame:
    """The most frequent values of a column among the create rows."""
    rows = events.where(F.col("operation") == create)
    return first_counts(value_counts(rows, [column], nulls=False), column, k)


def first_counts(counts: DataFrame, column: str, k: int) -> DataFrame:
    """The k largest counts, ties by value."""
    return counts.orderBy(F.desc("count"), column).limit(k)
