"""The analyses of an audit log as named reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timestamps import DAY_FIRST_FORMATS, FORENSIC_FORMATS, local_parser, shape_label
from ..operators import (
    actors, cases, events as ev, facts, fields, profile, quality, singles, stages, suggest, summary,
    temporal,
)
from ..operators.ordering import CREATE
from ..operators.skew import LARGE_GROUP_ROWS
from ..operators.topk import top_per_group
from .event_log import timed_events


@dataclass(frozen=True)
class ForensicInput:
    """timed: all rows, ts null where unreadable; events: the rows with ts."""

    timed: DataFrame
    events: DataFrame
    raw: str


def forensic_input(
    audit: DataFrame, *, raw: str = "logged_at", formats: Sequence[str] = FORENSIC_FORMATS
) -> ForensicInput:
    """Parse the times as the analyses read them; null old and new values become empty."""
    rows = ev.by_case_key(audit).withColumns(
        {c: F.coalesce(c, F.lit("")) for c in ("old_value", "new_value")}
    )
    parser = local_parser(formats)
    return ForensicInput(ev.with_time(rows, parser, raw), ev.valid_time(rows, parser, raw), raw)


def staged(source: ForensicInput, path: str) -> ForensicInput:
    """Write the parsed rows once and read them from there; ``staged_facts`` reads them four times."""
    source.timed.write.mode("overwrite").parquet(path)
    timed = source.timed.sparkSession.read.parquet(path)
    return ForensicInput(timed, timed.where(F.col("ts").isNotNull()), source.raw)


# What is counted in one pass over the rows, by subject.
SUBJECTS = {
    "fields": {"case": ("field", "case_id"), "old": ("field", "old_value"), "new": ("field", "new_value"),
               "operation": ("field", "operation")},
    "actors": {"case": ("actor", "case_id"), "field": ("actor", "field"), "operation": ("actor", "operation")},
    "cases": {**cases.CASE_FACTS, facts.ALL: (None, "case_id")},
    "known": {facts.ALL: ("_known", "_known_case")},
    "times": {"hour": (None, "_hour")},
    "shapes": {"shape": (None, "_shape")},
}


@dataclass(frozen=True)
class ForensicFacts:
    """All that the reports need, counted.

    values: rows per subject, kind, key and value; steps: the rows of the tracked
    fields; singles: the single-event rows; parsed: the timestamp summary.
    """

    values: DataFrame
    steps: DataFrame
    singles: DataFrame
    parsed: DataFrame

    def of(self, *subjects: str) -> DataFrame:
        return self.values.where(F.col("subject").isin(*subjects)).drop("subject")

    def with_all(self, subject: str) -> DataFrame:
        """The facts of a subject and, for the totals, the rows per case."""
        every = self.of("cases").where(F.col("kind") == facts.ALL)
        return self.of(subject).unionByName(every)

    def counts(self, subject: str, kind: str, key: str, value: str) -> DataFrame:
        return facts.counts_of(self.of(subject), kind, key, value)


def forensic_facts(source: ForensicInput) -> ForensicFacts:
    """The facts as frames that are not computed yet: one read of the rows for each of the four."""
    events = source.events
    known = F.col("field").isNotNull()
    shown = events.withColumns({
        "_hour": F.date_trunc("hour", "ts"), "_shape": shape_label(F.col(source.raw)),
        "_known": F.when(known, "known"), "_known_case": F.when(known, F.col("case_id")),
    })
    tracked = F.col("field").isin(*{*stages.TRANSITION_FIELDS, "stepname"})
    return ForensicFacts(
        facts.subject_facts(shown, SUBJECTS),
        events.where(tracked).select("case_id", "ts", "ingest_ord", "field", "new_value"),
        ev.single_event_rows(events),
        quality.timestamp_summary(source.timed),
    )


def staged_facts(source: ForensicInput, path: str) -> ForensicFacts:
    """Write the facts and read them from there.

    That is four reads of the rows; the forty reports read only the facts.
    """
    spark = source.timed.sparkSession
    found = forensic_facts(source)
    found.values.write.mode("overwrite").partitionBy("subject").parquet(f"{path}/values")
    for name in ("steps", "singles", "parsed"):
        getattr(found, name).write.mode("overwrite").parquet(f"{path}/{name}")
    return ForensicFacts(*[spark.read.parquet(f"{path}/{n}") for n in ("values", "steps", "singles", "parsed")])


def forensic_reports(found: ForensicFacts, *, limit: int = LARGE_GROUP_ROWS) -> dict[str, DataFrame]:
    """All analyses; run them over ``staged_facts``."""
    case_rows = cases.metrics_of(found.of("cases").where(F.col("kind") != facts.ALL))
    semantics = fields.semantics_of(found.with_all("fields"))
    # Cases count for the coverage by their rows that have a field.
    covered = found.of("fields").where((F.col("kind") == "case") & F.col("key").isNotNull())
    known = found.of("known").where(F.col("key").isNotNull()).withColumn("key", F.lit(None).cast("string"))
    coverage = fields.coverage_of(covered.unionByName(known))
    hours = found.of("times").select(F.col("value").cast("timestamp").alias("ts"), "rows")
    single, steps = found.singles, found.steps
    back = stages.stage_violations(steps, limit)
    moves = stages.transition_counts(steps, limit=limit)
    overview = summary.overview_of(found.of, steps, back, single, found.parsed)
    noise = summary.noise_candidates(semantics)
    operations = {c: found.counts(f"{c}s", "operation", c, "operation") for c in ("field", "actor")}
    by_actor = found.of("actors").where(F.col("kind") == "operation").groupBy(F.col("key").alias("actor"))

    def created(column: str, k: int) -> DataFrame:
        rows = operations[column].where((F.col("operation") == CREATE) & F.col(column).isNotNull())
        return singles.first_counts(rows.select(column, "count"), column, k)

    every_case = found.of("cases").where(F.col("kind") == facts.ALL).select(F.col("value").alias("case_id"))
    return {
        "timestamp_summary": found.parsed,
        "timestamp_shapes": found.of("shapes").select(F.col("value").alias("shape"), F.col("rows").alias("count")),
        "case_metrics": case_rows,
        "case_size_bands": cases.size_bands(case_rows),
        "case_duration_stats": cases.duration_stats(case_rows),
        "case_field_presence": cases.field_presence(case_rows),
        "field_semantics": semantics,
        "field_operations": operations["field"],
        "field_top_values": top_per_group(
            found.counts("fields", "new", "field", "new_value"), ["field"], ["new_value"], 5),
        "field_coverage": coverage,
        "actor_behavior": actors.behavior_of(found.with_all("actors").drop("created")),
        "actor_operations": operations["actor"],
        "actor_top_fields": top_per_group(found.counts("actors", "field", "actor", "field"), ["actor"], ["field"], 5),
        "actor_concentration": actors.concentration_of(by_actor.agg(F.sum("rows").alias("count"))),
        "stage_order": stages.stage_order(steps),
        "stepname_totals": stages.stepname_totals(steps),
        "stage_violations": back,
        "stage_violation_summary": stages.violation_summary(back),
        "temporal_hour": temporal.by_hour(hours),
        "temporal_weekday": temporal.by_weekday(hours),
        "temporal_month": temporal.by_month(hours),
        "temporal_daily_volume": temporal.daily_volume(hours),
        "temporal_shares": temporal.activity_shares(hours),
        "single_event_summary": singles.single_summary(every_case, single),
        "single_event_fields": singles.single_fields(single),
        "single_event_actors": singles.single_actors(single),
        "single_event_operations": singles.single_operations(single),
        "single_event_hypotheses": singles.hypotheses(single),
        "single_event_samples": singles.single_samples(single),
        "bulk_dates": singles.bulk_dates(single),
        "creation_summary": singles.creation_of(found.of("fields"), found.of("cases")),
        "creation_fields": created("field", 20),
        "creation_actors": created("actor", 10),
        "transition_totals": stages.transition_totals(moves),
        "top_transitions": stages.top_transitions(moves),
        "master_overview": overview,
        "high_signal_fields": summary.high_signal_fields(coverage),
        "noise_candidates": noise,
        "pipeline_recommendations": summary.recommendations(overview),
        "bucket_strategy": summary.bucket_strategy(coverage, noise),
    }


def bucket_reports(audit: DataFrame) -> dict[str, DataFrame]:
    """Field characteristics, suggested buckets, their counts, operations and top values."""
    rows = ev.by_case_key(audit)
    suggestions = suggest.bucket_suggestions(rows)
    return {
        "bucket_suggestions": suggestions,
        "suggested_bucket_counts": suggest.suggested_counts(suggestions),
        "suggested_bucket_fields": suggest.suggested_fields(suggestions),
        "field_characteristics_values": suggest.characteristic_values(rows),
    }


def abandoned_cases(audit: DataFrame, **options) -> DataFrame:
    """The rows of the cases that the event log drops as single-event cases."""
    return ev.single_event_rows(timed_events(audit, **options))


# The reports of each document.
DOCUMENTS = {
    "timestamp_analysis": ("timestamp_summary", "timestamp_shapes"),
    "case_lifecycle": ("case_size_bands", "case_duration_stats", "case_field_presence"),
    "field_semantics": ("field_semantics", "field_operations", "field_top_values", "field_coverage"),
    "actor_behavior": ("actor_behavior", "actor_operations", "actor_top_fields", "actor_concentration"),
    "sequence_analysis": ("stage_order", "stepname_totals", "stage_violation_summary"),
    "temporal_patterns": (
        "temporal_hour", "temporal_weekday", "temporal_month", "temporal_daily_volume", "temporal_shares",
    ),
    "single_event_forensics": (
        "single_event_summary", "single_event_fields", "single_event_actors", "single_event_operations",
        "single_event_hypotheses", "single_event_samples", "bulk_dates",
    ),
    "creation_patterns": ("creation_summary", "creation_fields", "creation_actors"),
    "transition_matrix": ("transition_totals", "top_transitions"),
    "master_summary": (
        "master_overview", "high_signal_fields", "noise_candidates", "pipeline_recommendations", "bucket_strategy",
    ),
}


def documents(reports: dict[str, DataFrame]) -> dict[str, dict[str, DataFrame]]:
    """The ten documents of ``forensic_reports``, each as its named reports."""
    return {name: {part: reports[part] for part in parts} for name, parts in DOCUMENTS.items()}


def profile_reports(table: DataFrame, date_column: str | None = None) -> dict[str, DataFrame]:
    """Column profile, frequent values and the profile of a date column."""
    reports = {
        "column_profile": profile.column_profile(table),
        "value_frequencies": profile.value_frequencies(table),
    }
    if date_column is not None:
        reports["date_profile"] = profile.date_profile(table, date_column)
    return reports


def latest_single_events(
    audit: DataFrame, *, raw: str = "logged_at", n: int = 10
) -> DataFrame:
    """The latest single-event rows when only day-first times with minutes count."""
    rows = ev.by_case_key(audit)
    timed = ev.valid_time(rows, local_parser(DAY_FIRST_FORMATS), raw)
    return singles.latest_singles(ev.single_event_rows(timed), n)
