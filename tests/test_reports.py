"""Analyses on hand-made rows."""

import json
import re

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan
from tracewright import catalog
from tracewright.fixtures import audit_log
from tracewright.functions.timestamps import iso_local
from tracewright.operators import (
    actors, cases, events as ev, fields, profile, quality, singles, stages, suggest, summary,
    temporal,
)
from tracewright.plans import forensic
from tracewright.sinks import tables


def rows(frame, *columns):
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


@pytest.fixture(scope="module")
def source(audit):
    log = audit(
        ("1", "Create", "ownerid", "a", "1/1/2025 10:00"),
        ("1", "Update", "stepname", "16-Propose", "2/1/2025 10:00"),
        ("1", "Update", "stepname", "Loose", "3/1/2025 10:00"),
        ("1", "Update", "stepname", "15-Develop", "4/1/2025 11:30"),
        ("1", "Update", "stepname", "15-Develop", "4/1/2025 11:30"),
        ("2", "Update", "the000g_revenuetype", "x" * 60, "5/1/25 17:59"),
        ("3", "Update", "ownerid", None, "5/1/25 18:00"),
        ("4", "Update", "stepname", "14-Qualify", "not a time"),
    )
    log = log.withColumn("actor", F.when(F.col("case_key") == "3", None).otherwise(F.col("actor")))
    return forensic.forensic_input(log)


@pytest.fixture(scope="module")
def nothing(audit):
    return forensic.forensic_input(audit(("1", "Update", "stepname", "14-Qualify", "never")))


def test_case_metrics(source):
    one = cases.case_metrics(source.events).where("case_id = '1'").first().asDict()
    assert (one["event_count"], one["unique_fields"], one["unique_actors"]) == (5, 2, 1)
    assert one["duration_days"] == 3.06 and one["has_create_event"] and one["has_stepname"]
    assert one["create_timestamp"] == one["first_timestamp"]
    assert (one["stepname_count"], one["owner_changes"], one["has_statecode"]) == (4, 1, False)
    three = cases.case_metrics(source.events).where("case_id = '3'").first()
    assert three["unique_actors"] == 0 and three["create_timestamp"] is None
    assert len(three) == 18


def test_case_reports(source):
    table = cases.case_metrics(source.events)
    assert dict(rows(cases.size_bands(table))) == {
        "1_event": 2, "2_5_events": 1, "6_10_events": 0, "11_plus_events": 0,
    }
    assert rows(cases.duration_stats(table)) == [(0.0, 3.06, 3.06 / 3, 0.0, 2)]
    assert dict(rows(cases.field_presence(table)))["has_stepname"] == 1


def test_field_reports(source):
    found = {r.field: r for r in fields.field_semantics(source.events).collect()}
    step, owner = found["stepname"], found["ownerid"]
    assert (step.occurrence_count, step.percentage_of_events, step.has_prefix) == (4, 57.14, True)
    assert (owner.unique_new_values, owner.empty_new_count, owner.has_prefix) == (2, 1, None)
    assert (owner.cases_affected, owner.percentage_of_cases) == (2, 66.67)
    top = rows(fields.field_top_values(source.events, 1), "field", "new_value", "count", "rank")
    assert ("stepname", "15-Develop", 2, 1) in top and ("ownerid", "", 1, 1) in top
    bands = dict(rows(fields.field_coverage(source.events), "field", "band"))
    assert bands["ownerid"] == "fields_above_50pct" and bands["stepname"] == "fields_25_to_50pct"


def test_a_missing_actor_is_a_group_of_its_own(source):
    found = {r.actor: r for r in actors.actor_behavior(source.events).collect()}
    assert found[None].event_count == 1 and found["A"].event_count == 6
    assert found["A"].activity_span_days == 4
    assert rows(actors.actor_concentration(source.events)) == [(85.71, 100.0, 2)]


def test_stage_reports(source):
    steps = stages.stage_violations(source.events).select(
        "case_id", iso_local(F.col("ts")).alias("ts"), "from_stage", "to_stage"
    )
    assert rows(steps) == [("1", "2025-01-04T11:30:00", "16-Propose", "15-Develop")]
    assert rows(stages.violation_summary(stages.stage_violations(source.events))) == [(1, 1)]
    assert rows(stages.stage_order(source.events)) == [(15, "Develop", 2), (16, "Propose", 1)]
    assert rows(stages.stepname_totals(source.events)) == [(4, 1, 3, 75.0)]


def test_transitions_count_repeats(source):
    counts = stages.transition_counts(source.events)
    assert rows(counts) == [
        ("stepname", "15-Develop", "15-Develop", 1),
        ("stepname", "16-Propose", "Loose", 1),
        ("stepname", "Loose", "15-Develop", 1),
    ]
    assert rows(stages.transition_totals(counts)) == [("stepname", 3, 3)]
    assert [r.to_value for r in stages.top_transitions(counts, 1).collect()] == ["15-Develop"]


def test_a_former_null_value_is_a_value(spark):
    events = spark.sql(
        "select 'statecode' field, '1' case_id, timestamp_ntz'2025-01-01 00:00:00' ts, id ingest_ord,"
        " if(id = 0, null, '1') new_value from range(2)"
    )
    assert rows(stages.transition_counts(events)) == [("statecode", None, "1", 1)]


def test_temporal_reports(source):
    assert dict(rows(temporal.by_weekday(source.events)))["Sunday"] == 2
    assert dict(rows(temporal.by_hour(source.events))) == {10: 3, 11: 2, 17: 1, 18: 1}
    assert rows(temporal.by_month(source.events)) == [(1, 7)]
    assert rows(temporal.daily_volume(source.events)) == [(7 / 5, 2, 1)]
    assert rows(temporal.activity_shares(source.events)) == [(57.14, 85.71)]


def test_single_event_reports(source):
    single = ev.single_event_rows(source.events)
    assert rows(single, "case_id") == [("2",), ("3",)]
    found = {r.field: r for r in singles.single_fields(single, 50).collect()}
    assert found["the000g_revenuetype"].sample_value == "x" * 50 + "..."
    whole = {r.field: r.sample_value for r in singles.single_fields(single).collect()}
    assert set(whole["the000g_revenuetype"]) == {"x"} and len(whole["the000g_revenuetype"]) > 50
    assert found["ownerid"].sample_actor is None and found["ownerid"].percentage_of_single_events == 50.0
    assert rows(singles.single_summary(source.events, single)) == [
        (2, 66.67, 2, False, 0, 2, 1, "A", 1)
    ]
    assert rows(singles.hypotheses(single)) == [(True, True, False, False)]
    assert rows(singles.bulk_dates(single, 1).select("count")) == [(2,)]
    assert [r.case_id for r in singles.single_samples(single, 1).collect()] == ["2"]
    assert [r.case_id for r in singles.latest_singles(single, 1).collect()] == ["3"]


def test_creation_reports(source):
    assert rows(singles.creation_summary(source.events)) == [(1, 1, 1.0)]
    assert rows(singles.creation_top(source.events, "field", 20)) == [("ownerid", 1)]


def test_timestamp_reports(source):
    found = quality.timestamp_summary(source.timed).first()
    assert (found.rows_after_parse, found.rows_dropped_invalid, found.timespan_days) == (7, 1, 4)
    assert dict(rows(quality.shape_counts(source.events, source.raw))) == {
        "DD/MM/YYYY HH:MM": 5, "D/M/YY HH:MM": 2,
    }


def test_overview_and_recommendations(source):
    row = summary.overview(source.timed, source.events).first().asDict()
    assert (row["total_events"], row["total_cases"], row["total_fields"]) == (7, 3, 3)
    assert (row["single_event_cases"], row["single_event_pct"]) == (2, 66.67)
    assert row["parse_success_rate"] == 87.5 and row["violation_cases"] == 1
    advice = dict(rows(summary.recommendations(summary.overview(source.timed, source.events))))
    assert advice == {
        "timestamp_handler": "dual_format_required",
        "case_filtering": "filter_2plus_events_recommended",
        "sequence_tiebreaker": "timestamp_only",
    }


def test_strategy(spark):
    coverage = spark.createDataFrame(
        [("developproposal", 30.0, "fields_25_to_50pct"), ("other", 30.0, "fields_25_to_50pct"),
         ("stepname", 60.0, "fields_above_50pct")],
        "field string, case_pct double, band string",
    )
    noise = spark.createDataFrame(
        [("totalamount", 9, 3.0)], "field string, occurrence_count bigint, percentage_of_cases double"
    )
    found = rows(summary.bucket_strategy(coverage, noise))
    assert ("L2_MILESTONE", "developproposal") in found and ("KILL_NOISE", "totalamount") in found
    assert ("L2_MILESTONE", "other") not in found
    assert rows(summary.high_signal_fields(coverage), "field") == [("stepname",)]


def test_noise_is_sought_among_the_most_frequent(spark):
    table = spark.createDataFrame(
        [("a", 9, 90.0), ("totalprice", 5, 10.0), ("pricebase", 1, 10.0), ("exchange", 7, 30.0)],
        "field string, occurrence_count bigint, percentage_of_cases double",
    )
    assert rows(summary.noise_candidates(table, among=3), "field") == [("totalprice",)]


def test_bucket_rules_in_order(spark):
    cases_ = [
        ("totaldiscount", 39.99, 9, "KILL_NOISE"), ("totaldiscount", 40.0, 9, "L3_ADMIN"),
        ("TotalState", 50.0, 9, "L1_STAGE"), ("developproposal", 1.0, 6, "L2_MILESTONE"),
        ("developproposal", 1.0, 5, "UNKNOWN"), ("customertype", 1.0, 5, "L3_ADMIN"),
        ("ownerid", 1.0, 1, "L3_ADMIN"), ("zz", 20.01, 1, "L3_ADMIN"), ("zz", 1.0, 51, "L3_ADMIN"),
        ("zz", 20.0, 50, "UNKNOWN"),
    ]
    table = spark.createDataFrame(
        cases_, "field string, case_coverage_pct double, total_occurrences bigint, want string"
    )
    wrong = table.where(suggest.suggested_bucket() != F.col("want")).collect()
    assert wrong == []


def test_characteristics(spark):
    table = spark.createDataFrame(
        [("f", "1", "", "a"), ("f", "1", " ", ""), ("f", "2", None, "b"), ("g", "3", "x", "y")],
        "field string, case_id string, old_value string, new_value string",
    )
    found = {r.field: r for r in suggest.field_characteristics(table).collect()}
    assert (found["f"].cases_affected, found["f"].case_coverage_pct) == (2, 66.67)
    assert (found["f"].unique_new_values, found["f"].unique_old_values) == (3, 2)
    assert found["f"].empty_old_pct == 100.0
    other = {r.field: r for r in suggest.field_characteristics(table, count_empty=False).collect()}
    assert (other["f"].unique_new_values, other["f"].unique_old_values) == (2, 1)


def test_column_profile(spark):
    table = spark.createDataFrame(
        [("a", 1, 0.5), ("", 2, None), (None, 2, 1.5), ("a", None, 4.0)], "s string, `n.1` int, d double"
    )
    found = {r.column: r.asDict() for r in profile.column_profile(table).collect()}
    s, n = found["s"], found["n.1"]
    assert (s["total_rows"], s["null_count"], s["empty_string_count"], s["unique_values"]) == (4, 1, 1, 2)
    assert (s["dtype"], s["min"], n["dtype"], n["min"], n["max"]) == ("string", None, "int", 1.0, 2.0)
    assert found["d"]["mean"] == 2.0 and n["non_null_count"] == 3
    top = rows(profile.value_frequencies(table, 1), "column", "value", "frequency", "percentage")
    assert ("s", "a", 2, 50.0) in top and ("n.1", "2", 2, 50.0) in top


def test_date_profile(spark):
    table = spark.createDataFrame([("1/2/2025 1:00",), ("2/12/25 1:00",), (None,)], "`when` string")
    found = profile.date_profile(table, "when").first()
    assert found.parse_failure_count == 1 and found.min_timestamp == found.max_timestamp


def test_every_report_on_nothing(nothing):
    for name, report in forensic.forensic_reports(forensic.forensic_facts(nothing)).items():
        assert report.count() >= 0, name
    assert summary.overview(nothing.timed, nothing.events).first()["parse_success_rate"] == 0.0


def test_reports_reach_files(spark, source, tmp_path):
    staged = forensic.staged(source, str(tmp_path / "staged"))
    reports = forensic.forensic_reports(forensic.staged_facts(staged, str(tmp_path / "facts")))
    chosen = {k: reports[k] for k in ("temporal_shares", "case_metrics", "transition_totals")}
    tables.write_reports(chosen, str(tmp_path / "reports"))
    text = "".join(p.read_text() for p in (tmp_path / "reports/temporal_shares").glob("*.json"))
    assert json.loads(text)["weekend_activity_pct"] == 57.14
    tables.write_case_metrics(reports["case_metrics"], str(tmp_path / "cases"))
    back = spark.read.option("header", True).csv(str(tmp_path / "cases"))
    assert len(back.columns) == 18 and back.first()["case_id"] == "1"
    tables.write_removed_cases(ev.single_event_rows(source.events), str(tmp_path / "removed"))
    removed = spark.read.option("header", True).csv(str(tmp_path / "removed"))
    assert {r.timestamp_utc for r in removed.collect()} == {"2025-01-05T17:59:00Z", "2025-01-05T18:00:00Z"}
    frequent = profile.value_frequencies(source.events.select("field", "operation"))
    tables.write_value_frequencies(frequent, str(tmp_path / "frequent"))
    assert spark.read.option("header", True).csv(str(tmp_path / "frequent")).columns == [
        "column", "value", "frequency", "percentage",
    ]


def direct(events, timed, raw):
    """Every report by its own reads of the rows."""
    case_rows, single = cases.case_metrics(events), ev.single_event_rows(events)
    semantics, coverage = fields.field_semantics(events), fields.field_coverage(events)
    back, moves = stages.stage_violations(events), stages.transition_counts(events)
    overview, noise = summary.overview(timed, events), summary.noise_candidates(semantics)
    return {
        "timestamp_summary": quality.timestamp_summary(timed), "timestamp_shapes": quality.shape_counts(events, raw),
        "case_metrics": case_rows, "case_size_bands": cases.size_bands(case_rows),
        "case_duration_stats": cases.duration_stats(case_rows), "case_field_presence": cases.field_presence(case_rows),
        "field_semantics": semantics, "field_operations": fields.field_operations(events),
        "field_top_values": fields.field_top_values(events), "field_coverage": coverage,
        "actor_behavior": actors.actor_behavior(events), "actor_operations": actors.actor_operations(events),
        "actor_top_fields": actors.actor_top_fields(events), "actor_concentration": actors.actor_concentration(events),
        "stage_order": stages.stage_order(events), "stepname_totals": stages.stepname_totals(events),
        "stage_violations": back, "stage_violation_summary": stages.violation_summary(back),
        "temporal_hour": temporal.by_hour(events), "temporal_weekday": temporal.by_weekday(events),
        "temporal_month": temporal.by_month(events), "temporal_daily_volume": temporal.daily_volume(events),
        "temporal_shares": temporal.activity_shares(events), "single_event_summary": singles.single_summary(events, single),
        "single_event_fields": singles.single_fields(single), "single_event_actors": singles.single_actors(single),
        "single_event_operations": singles.single_operations(single),
        "single_event_hypotheses": singles.hypotheses(single), "single_event_samples": singles.single_samples(single),
        "bulk_dates": singles.bulk_dates(single), "creation_summary": singles.creation_summary(events),
        "creation_fields": singles.creation_top(events, "field", 20),
        "creation_actors": singles.creation_top(events, "actor", 10),
        "transition_totals": stages.transition_totals(moves), "top_transitions": stages.top_transitions(moves),
        "master_overview": overview, "high_signal_fields": summary.high_signal_fields(coverage),
        "noise_candidates": noise, "pipeline_recommendations": summary.recommendations(overview),
        "bucket_strategy": summary.bucket_strategy(coverage, noise),
    }


@pytest.mark.parametrize("grain", ["day", "user"])
def test_reports_from_facts_are_the_direct_ones(spark, tmp_path, grain):
    """Forty reports from four reads of the parsed rows."""
    log = audit_log(spark, "/root/testdata/sf0.001", grain).drop("logged_at")
    gap = F.col("ingest_ord") % 41 == 0  # some rows without a field, actor or operation
    log = log.withColumns({c: F.when(~gap, F.col(c)) for c in ("field", "operation")})
    log = log.withColumn("actor", F.when(F.col("ingest_ord") % 43 > 0, F.col("actor")))
    source = forensic.forensic_input(log, raw="logged_at_forensic")
    rows_path = str(tmp_path / "rows")
    source = forensic.staged(source, rows_path)
    for frame in vars(forensic.forensic_facts(source)).values():
        assert plan(frame).count("FileScan") == 1
    found = forensic.forensic_reports(forensic.staged_facts(source, str(tmp_path / "facts")))
    wanted = direct(source.events, source.timed, source.raw)
    assert set(found) == set(wanted)
    for name, report in found.items():
        text = report._jdf.queryExecution().toString()
        assert rows_path not in text, name
        assert sorted(report.columns) == sorted(wanted[name].columns), name
        columns = sorted(report.columns)
        assert rows(report, *columns) == rows(wanted[name], *columns), name


@pytest.mark.parametrize("name", [
    "field_semantics", "actor_behavior", "field_characteristics", "bucket_suggestions", "case_metrics",
    "field_coverage_bands",
])
def test_distinct_counts_and_totals_from_one_read(spark, name):
    query = catalog.queries()[name](spark, "/root/testdata/sf0.001")
    assert "Expand" not in plan(query)
    query.collect()
    assert scans_that_ran(query) == 1


def scans_that_ran(frame):
    """Scans in the final plan of a frame and of its subqueries, after it has run."""
    count, hidden = 0, None
    for line in frame._jdf.queryExecution().executedPlan().toString().splitlines():
        branch = re.match(r"[ :|]*\+- ", line)
        if branch and hidden is not None and branch.end() <= hidden:
            hidden = None
        if "== Initial Plan ==" in line and hidden is None:
            hidden = branch.end()
        count += line.count("FileScan") if hidden is None else 0
    return count


def test_latest_single_events(audit):
    log = audit(
        ("1", "U", "f", "v", "1/1/2025 1:00"), ("1", "U", "f", "v", "2025-01-01T00:00:00Z"),
        ("2", "U", "f", "v", "2/1/2025 1:00"), ("3", "U", "f", "v", "3/1/2025 1:00"),
        ("3", "U", "f", "v", "4/1/2025 1:00"),
    )
    assert [r.case_id for r in forensic.latest_single_events(log).collect()] == ["2", "1"]


def test_other_jobs(audit):
    log = audit(("1", "Update", "statecode", "1", "1/1/2025 1:00"), ("2", "Update", "zz", "1", "x"))
    found = forensic.bucket_reports(log)
    assert dict(rows(found["suggested_bucket_counts"])) == {"L1_STAGE": 1, "L3_ADMIN": 1}
    assert rows(found["suggested_bucket_fields"], "suggested_bucket", "place", "field") == [
        ("L1_STAGE", 1, "statecode"), ("L3_ADMIN", 1, "zz")]
    assert ("statecode", "operation", "Update", 1, 1) in rows(found["field_characteristics_values"])
    reports = forensic.profile_reports(log.drop("ingest_ord"), "logged_at")
    assert reports["date_profile"].first().parse_failure_count == 1


def test_documents_and_abandoned_cases(source, audit, tmp_path):
    reports = forensic.forensic_reports(forensic.forensic_facts(source))
    made = forensic.documents(reports)
    assert len(made) == 10 and all(parts for parts in made.values())
    wanted = {"creation_patterns": made["creation_patterns"], "temporal_patterns": made["temporal_patterns"]}
    tables.write_documents(wanted, str(tmp_path / "documents"))
    text = source.events.sparkSession.read.text(str(tmp_path / "documents" / "temporal_patterns")).first().value
    parsed = json.loads(text)
    assert set(parsed) == set(forensic.DOCUMENTS["temporal_patterns"])
    assert len(parsed["temporal_weekday"]) >= 1 and len(parsed["temporal_shares"]) == 1
    log = audit(("1", "U", "f", "v", "1/1/2025 1:00"), ("2", "U", "f", "v", "2/1/2025 1:00"),
                ("2", "U", "g", "v", "3/1/2025 1:00"), ("3", "U", "g", "v", "no time"))
    gone = forensic.abandoned_cases(log)
    tables.write_removed_cases(gone, str(tmp_path / "gone"))
    assert [r.case_id for r in gone.collect()] == ["1"]
