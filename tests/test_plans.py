"""What the plans must look like to hold up on large data."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from tracewright import catalog
from tracewright.fixtures import audit_log
from tracewright.operators import cases, classify, events as ev, ordering, stages, topk
from tracewright.plans import event_log as log
from tracewright.sinks.tables import write_case_table

SF = "/root/testdata/sf0.001"


def plan(frame):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain()
    return text.getvalue()


def plan_that_ran(frame):
    """The final plan of the branch for ordinary cases; the other one reads nothing, as no case is large."""
    frame.collect()
    text = plan(frame).split("== Initial Plan ==")[0]
    lines = text.splitlines()
    place = min(line.index(":- ") for line in lines if re.match(r" *:- ", line))
    last = next(i for i, line in enumerate(lines) if line[:place].isspace() and line[place : place + 3] == "+- ")
    assert "EmptyRelation" in "".join(lines[last:])
    return "\n".join(lines[:last])


@pytest.fixture(scope="module")
def event_log_plan(spark):
    return plan_that_ran(log.event_log(audit_log(spark, SF), classify.default_rules(spark)))


def test_event_log_shuffles_once(event_log_plan):
    assert event_log_plan.count("Exchange hashpartitioning") == 1
    assert "hashpartitioning(case_id" in event_log_plan


def test_event_log_sorts_three_times(event_log_plan):
    # One sort serves the case sizes and the create rows, one the duplicates, one the places.
    assert event_log_plan.count("Sort [") == 3


@pytest.mark.parametrize("name", ["single_event_rows", "single_event_summary", "recent_single_event"])
def test_single_events_need_no_sort_aggregate(spark, name):
    # A total over few actors may be one; it sorts nothing. Rows must not be sorted by a key.
    assert not re.search(r"SortAggregate\(key=\[\w", plan(catalog.queries()[name](spark, SF)))


def test_doubled_rules_do_not_double_events(spark):
    rules = classify.default_rules(spark)
    twice = classify.Rules(rules.buckets.union(rules.buckets), rules.codes.union(rules.codes))
    rows = audit_log(spark, SF)
    assert classify.named(rows, twice).exceptAll(classify.named(rows, rules)).isEmpty()
    assert classify.named(rows, twice).count() == rows.count()


def test_event_log_joins_rules_without_shuffling(event_log_plan):
    assert event_log_plan.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in event_log_plan


def test_times_are_parsed_once(event_log_plan):
    assert event_log_plan.count("explode(") == 1


def test_traces_add_no_shuffle(spark):
    assert plan_that_ran(catalog.queries()["xes_traces"](spark, SF)).count("Exchange hashpartitioning") == 1


def test_duplicates_shrink_before_the_shuffle(spark):
    events = spark.sql(
        "select id % 2 case_id, id % 3 activity_name, id % 5 ts, string(id) bucket,"
        " string(id) field, id sequence, id > 4 is_create, id ingest_ord from range(9)"
    )
    text = plan(ordering.deduplicated(events))
    assert text.index("Partial") > text.index("Exchange hashpartitioning") > text.index("Final")


def test_top_values_shrink_before_the_shuffle(spark):
    counts = spark.range(9).selectExpr("id % 2 g", "id v", "id count")
    text = plan(topk.top_per_group(counts, ["g"], ["v"], 5))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_scans_read_only_what_they_need(spark):
    text = plan(catalog.queries()["temporal_hour"](spark, SF))
    schema = text[text.index("ReadSchema") :].splitlines()[0]
    assert "user_id" not in schema and "value" not in schema and "event_type" not in schema


def test_sizing_cases_needs_no_parsing(spark):
    audit = ev.with_case_ids(audit_log(spark, SF))
    counted = audit.groupBy("case_id").agg(F.count("*"))
    assert "explode" not in plan(counted) and "event_type" not in plan(counted)


@pytest.mark.parametrize("build", [cases.case_metrics, stages.stage_violations])
def test_jobs_over_the_case_table_do_not_shuffle_events(spark, tmp_path, build):
    made = log.event_log(audit_log(spark, SF, "user"), classify.default_rules(spark))
    table = write_case_table(made, f"t_{build.__name__}", str(tmp_path / "table"))
    found = build(table)
    found.collect()
    text = plan(found).split("== Initial Plan ==")[0]
    assert "Bucketed: true" in text and "Exchange hashpartitioning" not in text.split("EmptyRelation")[0]
    wanted = build(spark.read.parquet(str(tmp_path / "table")))
    columns = wanted.columns
    assert found.exceptAll(wanted.select(columns)).isEmpty() and found.count() == wanted.count() > 0
