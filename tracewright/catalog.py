"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import audit_log, write_audit_csv
from .functions.timestamps import iso_local, iso_utc, utc_parser
from .operators import (
    actors, cases, classify, events as ev, fields, ordering, profile, quality, singles, stages,
    suggest, summary, temporal,
)
from .plans import event_log as log, forensic
from .sinks.tables import document, write_case_metrics, write_case_table, write_value_frequencies
from .sinks.xes import trace_events, write_xes
from .operators.skew import shared_path
from .sources.audit import audit_rows, read_audit_csv, read_bad_lines
from .sources.xes import read_long_xes

# Headers under which the sources hold the canonical columns.
RAW_HEADERS = {
    "Item ID": "case_key", "Action": "operation", "Attribute": "field", "Old value": "old_value",
    "New value": "new_value", "Anon Actor": "actor", "Timestamp": "logged_at",
}
Query = Callable[[SparkSession, str], DataFrame]


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_log(spark, sf_dir).drop("logged_at_forensic")


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.timed_events(_audit(spark, sf_dir))


def _multi(audit: DataFrame) -> DataFrame:
    """Rows of multi-event cases. Unparsed rows bound the case sizes from above."""
    return ev.multi_event_rows(log.timed_events(audit), counted=ev.with_case_ids(audit))


def _named(audit: DataFrame) -> DataFrame:
    """Rows with a time, without noise fields, named; all cases."""
    rules = classify.default_rules(audit.sparkSession)
    return classify.named(classify.without_kill_fields(log.timed_events(audit), rules), rules)


def _collapsed(audit: DataFrame) -> DataFrame:
    named = ordering.with_create_flag(_named(audit))
    return ordering.create_aggregated(named, counted=ev.with_case_ids(audit))


def _forensic(spark: SparkSession, sf_dir: str, grain: str = "day") -> forensic.ForensicInput:
    audit = audit_log(spark, sf_dir, grain).drop("logged_at")
    return forensic.forensic_input(audit, raw="logged_at_forensic")


def _text(frame: DataFrame, *columns: str) -> DataFrame:
    """Show times as the reports do."""
    return frame.withColumns({c: iso_local(F.col(c)) for c in columns})


def _utc(frame: DataFrame) -> DataFrame:
    """Show ts as timestamp_utc, as the sinks do."""
    return frame.withColumn("timestamp_utc", iso_utc(F.col("ts"))).drop("ts")


def _plain(frame: DataFrame) -> DataFrame:
    """Show the nullable sequence as text, so that no reader turns it into a float."""
    return frame.withColumn("sequence", F.col("sequence").cast("string"))


def _on_events(build: Callable[[DataFrame], DataFrame], *times: str, grain: str = "day") -> Query:
    """A report over the rows with a time."""
    return lambda spark, sf: _text(build(_forensic(spark, sf, grain).events), *times)


def _on_cases(build: Callable[[DataFrame], DataFrame], grain: str = "day") -> Query:
    return _on_events(lambda events: build(cases.case_metrics(events)), grain=grain)


def _on_singles(build: Callable[[DataFrame], DataFrame], *times: str) -> Query:
    return _on_events(lambda events: build(ev.single_event_rows(events)), *times)


def _on_moves(build: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = _forensic(spark, sf_dir, "user")
        return build(stages.transition_counts(source.events, counted=source.timed))

    return query


def _on_steps_back(build: Callable[[DataFrame], DataFrame], *times: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = _forensic(spark, sf_dir, "user")
        return _text(build(stages.stage_violations(source.events, counted=source.timed)), *times)

    return query


def _raw_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit log under headers and with white space as exports have them."""
    rows = audit_log(spark, sf_dir)
    return rows.select(
        "ingest_ord",
        F.concat(F.lit("\t"), "case_key", F.lit(" ")).alias("\ufeffAnon  Item ID"),
        F.col("operation").alias("action"),
        F.concat(F.lit(" "), "field").alias("Field_Name"),
        F.coalesce("old_value", F.lit("NaN")).alias("Previous value"),
        F.when(F.col("new_value") == "", "N/A").otherwise(F.col("new_value")).alias("NEW VALUE"),
        F.col("actor").alias("Anon Actor"),
        F.concat("logged_at", F.lit(" \n")).alias("Actor Date Log"),
        F.col("logged_at_forensic").alias("Extra  Note"),
    )


def _audit_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("ingest_ord")
    return audit_rows(_raw_audit(spark, sf_dir), ingest_ord=order)


def _csv_files(spark: SparkSession, sf_dir: str) -> str:
    """The log as CSV files of two kinds of header, some lines broken."""
    return write_audit_csv(spark, sf_dir, shared_path(spark, "audit-csv"))


def _audit_scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the CSV files without the broken lines."""
    rows = read_audit_csv(spark, _csv_files(spark, sf_dir), bad_lines="drop")
    return rows.drop("ingest_ord", "file").withColumnRenamed("Event", "event")


def _audit_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bad_lines(spark, _csv_files(spark, sf_dir)).select("line")


def _parse_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = ev.with_time(_audit(spark, sf_dir), utc_parser())
    return _utc(timed.select("ingest_ord", "logged_at", "ts"))


def _parse_forensic(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = _forensic(spark, sf_dir).timed
    return _text(timed.select("ingest_ord", "logged_at_forensic", "ts"), "ts")


def _iso_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of the events as ISO week dates, some of weeks that do not exist."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    year, number = F.extract(F.lit("YEAROFWEEK"), "ts").cast("string"), F.lpad(F.weekofyear("ts").cast("string"), 2, "0")
    day, form = (F.weekday("ts") + 1).cast("string"), F.col("event_id") % 8
    clock = F.date_format("ts", "HH:mm:ss")
    text = (
        F.when(form == 0, F.concat(year, F.lit("-W"), number, F.lit("-"), day, F.lit("T"), clock, F.lit("Z")))
        .when(form == 1, F.concat(year, F.lit("W"), number, day, F.lit(" "), F.replace(clock, F.lit(":"), F.lit(""))))
        .when(form == 2, F.concat(year, F.lit("-W"), number))
        .when(form == 3, F.concat(year, F.lit("W"), number, F.lit("T"), clock, F.lit("+05:30")))
        .when(form == 4, F.concat(year, F.lit("-W"), number, F.lit("-"), F.substring(clock, 1, 5)))
        .when(form == 5, F.concat(year, F.lit("-W53-4")))
        .when(form == 6, F.concat(year, F.lit("W"), number, F.lit("8")))
        .otherwise(F.concat(year, F.lit("W"), number, day))
    )
    timed = ev.with_time(events.select("event_id", text.alias("logged_at")), utc_parser())
    return _utc(timed)


def _case_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.lit("  "), F.replace("case_key", F.lit("-"), F.lit(" \t ")), F.lit("\n"))
    rows = _audit(spark, sf_dir).select("ingest_ord", key.alias("case_key"))
    return ev.with_case_ids(rows).select("ingest_ord", "case_id")


def _rules_query(build: Callable[[DataFrame, classify.Rules], DataFrame]) -> Query:
    return lambda spark, sf: build(_audit(spark, sf), classify.default_rules(spark))


def _bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per bucket after the single-event and noise filters."""
    rules = classify.default_rules(spark)
    kept = classify.without_kill_fields(_multi(_audit(spark, sf_dir)), rules)
    buckets = classify.bucketed(kept, rules)
    return buckets.groupBy("bucket", "level").agg(F.count("*").alias("rows"))


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = _audit(spark, sf_dir)
    return _plain(_utc(log.event_log(audit, classify.default_rules(spark))))


def _exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.exported_events(_audit(spark, sf_dir), classify.default_rules(spark))


def _events_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exported(spark, sf_dir).groupBy("level").agg(
        F.count("*").alias("events"), F.countDistinct("case_id").alias("cases")
    )


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = _audit(spark, sf_dir)
    placed = ordering.with_event_pos(_collapsed(audit), counted=ev.with_case_ids(audit))
    return _utc(placed.select("case_id", "event_pos", "ts", "activity_name", "ingest_ord"))


def _created(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["case_id", "ingest_ord", "operation", "activity_name", "level", "sequence", "ts"]
    return _plain(_utc(_collapsed(_audit(spark, sf_dir)).select(*columns)))


def _deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ordering.deduplicated(_collapsed(_audit(spark, sf_dir)))
    return _utc(kept.select("case_id", "activity_name", "ts", "ingest_ord"))


def _overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _forensic(spark, sf_dir, "user")
    return summary.overview(source.timed, source.events)


def _noise(events: DataFrame) -> DataFrame:
    return summary.noise_candidates(fields.field_semantics(events))


def _strategy(events: DataFrame) -> DataFrame:
    return summary.bucket_strategy(fields.field_coverage(events), _noise(events))


def _case_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log as a table bucketed by case."""
    path = shared_path(spark, "case-table")
    name = f"case_table_{path.rsplit('-', 1)[1]}"
    made = log.event_log(_audit(spark, sf_dir), classify.default_rules(spark))
    return write_case_table(made, name, path)


def _metrics_of_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cases.case_metrics(_case_table(spark, sf_dir))
    return _text(found, "first_timestamp", "last_timestamp", "create_timestamp")


def _violations_of_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(stages.stage_violations(_case_table(spark, sf_dir)), "ts")


def _xes_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported events as the XES reader finds them in the written files."""
    path = shared_path(spark, "log-xes")
    write_xes(_exported(spark, sf_dir), path)
    parts = [read_long_xes(spark, f"{path}/level={x}").withColumn("level", F.lit(x)) for x in classify.EXPORT_LEVELS]
    return reduce(DataFrame.unionByName, parts)


def _through_csv(made: DataFrame, write: Callable[[DataFrame, str], None], columns: list[str]) -> DataFrame:
    """The rows as they are read from the CSV files that a sink writes."""
    spark = made.sparkSession
    path = shared_path(spark, "csv")
    write(made, path)
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.schema(made.select(columns).schema).csv(path)


def _metrics_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = cases.case_metrics(_forensic(spark, sf_dir).events)
    found = _through_csv(made, write_case_metrics, made.columns)
    return _text(found, "first_timestamp", "last_timestamp", "create_timestamp")


def _frequencies_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = profile.value_frequencies(_profile_table(spark, sf_dir))
    return _through_csv(made, write_value_frequencies, [c for c in made.columns if c != "rank"])


def _log_of_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log of a set of sources, the audit log under raw headers."""
    table = _audit_scan(spark, sf_dir).withColumnsRenamed({v: k for k, v in RAW_HEADERS.items()})
    sources = {"audit_log": table, "main_case_table": spark.range(1)}
    found = log.event_log_of(sources, classify.default_rules(spark))
    return _plain(_utc(found.drop("ingest_ord", "Extra Note")))


def _report_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three of the report documents as JSON text, made from the written facts."""
    source = forensic.staged(_forensic(spark, sf_dir), shared_path(spark, "forensic-rows"))
    made = forensic.documents(forensic.forensic_reports(
        forensic.staged_facts(source, shared_path(spark, "forensic-facts"))))
    names = ("creation_patterns", "transition_matrix", "temporal_counts")
    made["temporal_counts"] = {n: made["temporal_patterns"][n] for n in ("temporal_hour", "temporal_weekday", "temporal_month")}
    texts = [document(made[name]).select(F.lit(name).alias("name"), "value") for name in names]
    return texts[0].unionByName(texts[1]).unionByName(texts[2])


def _on_raw(build: Callable[[DataFrame], DataFrame]) -> Query:
    """A report over all rows, unparsed."""
    return lambda spark, sf: build(_filled(spark, sf))


def _filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All audit rows, unparsed, nulls as empty texts."""
    rows = ev.by_case_key(_audit(spark, sf_dir))
    return rows.withColumn("old_value", F.coalesce("old_value", F.lit("")))


def _profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole audit log, place numbers and both forms of the time included."""
    return audit_log(spark, sf_dir)


def _typed_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    return profile.column_profile(table).withColumn("mean", F.round("mean", 4))


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forensic.latest_single_events(_audit(spark, sf_dir))
    return _text(
        found.select("case_id", "ts", "operation", "field", "new_value", "actor"), "ts"
    )


def _cleaned(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, int]]:
    """The log and the removed cases, written in one job, and the counts of that job."""
    path = shared_path(spark, "cleaned")
    return path, log.clean(_audit(spark, sf_dir), classify.default_rules(spark), path)


def _removed_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(log.removed_cases(spark, _cleaned(spark, sf_dir)[0]))


def _cleaned_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_utc(log.cleaned_log(spark, _cleaned(spark, sf_dir)[0])))


def _step_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that the writing job made on its way."""
    return spark.createDataFrame(list(_cleaned(spark, sf_dir)[1].items()), "step string, rows bigint")


def _step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.step_counts(_audit(spark, sf_dir), classify.default_rules(spark))


def queries() -> dict[str, Query]:
    """Name to query, in the order of the survey."""
    return {
        # sources and timestamps
        "audit_scan": _audit_scan,
        "audit_scan_csv": _audit_scan_csv,
        "audit_bad_lines": _audit_bad_lines,
        "ts_parse_pipeline": _parse_pipeline,
        "ts_parse_forensic": _parse_forensic,
        "ts_iso_weeks": _iso_weeks,
        "ts_valid_rows": lambda s, d: _utc(_timed(s, d).select("ingest_ord", "case_id", "ts")),
        "ts_drop_reasons": lambda s, d: ev.invalid_time(_audit(s, d), utc_parser()).select(
            "ingest_ord", "logged_at", "drop_reason"
        ),
        "utc_invalid_rows": lambda s, d: ev.not_strict_utc(_audit(s, d), "logged_at").select(
            "ingest_ord", "logged_at"
        ),
        "case_ids_normalized": _case_ids,
        # cleaning
        "multi_event_rows": lambda s, d: _utc(_multi(_audit(s, d))),
        "single_event_rows": lambda s, d: _utc(ev.single_event_rows(_timed(s, d))),
        "kill_filtered": _rules_query(classify.without_kill_fields),
        "bucketed_events": _rules_query(classify.bucketed),
        "bucket_counts": _bucket_counts,
        "translated_events": _rules_query(classify.translated),
        "sequence_numbers": lambda s, d: _plain(classify.sequenced(_audit(s, d))),
        "activity_names": lambda s, d: _plain(_named(_audit(s, d))).select(
            "ingest_ord", "bucket", "level", "translated_value", "sequence", "activity_name"
        ),
        "create_aggregated": _created,
        "canonical_event_order": _canonical,
        "deduplicated_events": _deduplicated,
        "event_log": _event_log,
        "events_by_level": _events_by_level,
        "xes_traces": lambda s, d: trace_events(_exported(s, d)),
        "xes_read_back": _xes_read_back,
        "pipeline_step_counts": _step_counts,
        "event_log_of_sources": _log_of_sources,
        "cleaned_log": _cleaned_log,
        "removed_cases": _removed_cases,
        "pipeline_step_metrics": _step_metrics,
        # cases
        "case_metrics": _on_events(
            cases.case_metrics, "first_timestamp", "last_timestamp", "create_timestamp"
        ),
        "case_metrics_csv": _metrics_csv,
        "case_metrics_of_table": _metrics_of_table,
        "stage_violations_of_table": _violations_of_table,
        "case_size_bands": _on_cases(cases.size_bands),
        "case_size_bands_by_user": _on_cases(cases.size_bands, grain="user"),
        "case_duration_stats": _on_cases(cases.duration_stats, grain="user"),
        "case_field_presence": _on_cases(cases.field_presence),
        # fields
        "field_semantics": _on_events(fields.field_semantics),
        "field_operations": _on_events(fields.field_operations),
        "field_top_values": _on_events(fields.field_top_values),
        "field_coverage_bands": _on_events(fields.field_coverage, grain="user"),
        # actors
        "actor_behavior": _on_events(actors.actor_behavior, "first_activity", "last_activity"),
        "actor_operations": _on_events(actors.actor_operations),
        "actor_top_fields": _on_events(actors.actor_top_fields),
        "actor_concentration": _on_events(actors.actor_concentration),
        # stages and transitions
        "stage_order": _on_events(stages.stage_order, grain="user"),
        "stepname_totals": _on_events(stages.stepname_totals, grain="user"),
        "stage_violations": _on_steps_back(lambda steps: steps, "ts"),
        "stage_violation_summary": _on_steps_back(stages.violation_summary),
        "transition_counts": _on_moves(lambda moves: moves),
        "transition_totals": _on_moves(stages.transition_totals),
        "top_transitions": _on_moves(stages.top_transitions),
        # time
        "ts_format_distribution": _on_events(
            lambda e: quality.shape_counts(e, "logged_at_forensic")
        ),
        "timestamp_summary": lambda s, d: _text(
            quality.timestamp_summary(ev.with_time(_audit(s, d), utc_parser())),
            "min_timestamp", "max_timestamp",
        ),
        "temporal_hour": _on_events(temporal.by_hour),
        "temporal_weekday": _on_events(temporal.by_weekday),
        "temporal_month": _on_events(temporal.by_month),
        "temporal_daily_volume": _on_events(temporal.daily_volume),
        "temporal_shares": _on_events(temporal.activity_shares),
        # single-event cases and creation
        "single_event_fields": _on_singles(singles.single_fields),
        "single_event_actors": _on_singles(singles.single_actors),
        "single_event_operations": _on_singles(singles.single_operations),
        "single_event_summary": _on_events(
            lambda e: singles.single_summary(e, ev.single_event_rows(e))
        ),
        "single_event_samples": _on_singles(singles.single_samples, "ts"),
        "single_event_hypotheses": _on_singles(singles.hypotheses),
        "bulk_dates": _on_singles(
            lambda rows: singles.bulk_dates(rows).withColumn("date", F.col("date").cast("string"))
        ),
        "recent_single_event": _latest,
        "creation_summary": _on_events(singles.creation_summary),
        "creation_fields": _on_events(lambda e: singles.creation_top(e, "field", 20)),
        "creation_actors": _on_events(lambda e: singles.creation_top(e, "actor", 10)),
        # summary
        "master_overview": lambda s, d: _text(
            _overview(s, d), "min_timestamp", "max_timestamp"
        ),
        "high_signal_fields": _on_events(
            lambda e: summary.high_signal_fields(fields.field_coverage(e)), grain="user"
        ),
        "noise_candidates": _on_events(_noise),
        "report_documents": _report_documents,
        "pipeline_recommendations": lambda s, d: summary.recommendations(_overview(s, d)),
        "bucket_strategy": _on_events(_strategy),
        # profiles
        "column_profile": lambda s, d: profile.column_profile(_profile_table(s, d)),
        "column_profile_typed": _typed_profile,
        "date_profile": lambda s, d: _text(
            profile.date_profile(_audit(s, d), "logged_at"), "min_timestamp", "max_timestamp"
        ),
        "value_frequencies": lambda s, d: profile.value_frequencies(_profile_table(s, d)),
        "value_frequencies_csv": _frequencies_csv,
        "field_characteristics": _on_raw(suggest.field_characteristics),
        "bucket_suggestions": _on_raw(suggest.bucket_suggestions),
        "field_characteristics_values": _on_raw(suggest.characteristic_values),
        "suggested_bucket_fields": _on_raw(
            lambda rows: suggest.suggested_fields(suggest.bucket_suggestions(rows))
        ),
        "suggested_bucket_counts": _on_raw(
            lambda rows: suggest.suggested_counts(suggest.bucket_suggestions(rows))
        ),
    }
