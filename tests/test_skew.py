"""Large groups must give what ordinary groups give."""

import pytest
from pyspark.sql import functions as F

from tracewright.fixtures import audit_log
from tracewright.operators import classify, events as ev, ordering, skew, stages
from tracewright.plans import event_log as log, forensic

SF = "/root/testdata/sf0.001"


def same(left, right):
    columns = sorted(left.columns)
    assert sorted(right.columns) == columns
    left, right = left.select(columns), right.select(columns)
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture(scope="module")
def rows(spark):
    """One group with two thirds of the rows, a third of them at one instant."""
    n = F.col("id")
    group = F.when(n % 3 < 2, "hot").when(n % 30 == 2, None).otherwise(F.concat(F.lit("g"), n % 7))
    time = F.when(n % 3 == 0, F.lit(500)).otherwise((n * 37) % 1000)
    frame = spark.range(0, 3000, 1, 6).select(
        group.alias("g"), time.alias("t"), n.alias("ord"), (n % 5).alias("v")
    )
    return frame.repartition(5).persist()


def test_large_groups(rows):
    assert [r.g for r in skew.large_groups(rows, ["g"], 1000).collect()] == ["hot"]
    assert skew.large_groups(rows, ["g"], 10_000).isEmpty()


@pytest.mark.parametrize("limit", [90, 150, 1000])
def test_previous(rows, limit):
    def run(at):
        return skew.with_previous(rows, ["g"], ["t", "ord"], ["v", "ord"], limit=at)

    same(run(limit), run(10**9))


@pytest.mark.parametrize("limit", [90, 150, 1000])
def test_positions(rows, limit):
    def run(at):
        return skew.with_position(rows, ["g"], ["t", "ord"], "pos", limit=at)

    same(run(limit), run(10**9))


def test_first_per_key_matches_brute_force(rows):
    got = {(r.g, r.v): (r.t, r.ord) for r in skew.first_per_key(rows, ["g", "v"], ["t", "ord"]).collect()}
    want = {}
    for r in rows.collect():
        want[r.g, r.v] = min(want.get((r.g, r.v), (r.t, r.ord)), (r.t, r.ord))
    assert got == want


@pytest.mark.parametrize("limit", [1, 4])
def test_event_log(spark, limit):
    audit, rules = audit_log(spark, SF), classify.default_rules(spark)
    same(log.event_log(audit, rules, limit=limit), log.event_log(audit, rules))
    same(log.exported_events(audit, rules, limit=limit), log.exported_events(audit, rules))


@pytest.mark.parametrize("limit", [25, 60])
def test_steps_of_cleaning(spark, limit):
    rules = classify.default_rules(spark)
    timed = log.timed_events(audit_log(spark, SF, "user"))
    same(ev.multi_event_rows(timed, limit), ev.multi_event_rows(timed))
    named = ordering.with_create_flag(classify.named(timed, rules))
    same(ordering.create_aggregated(named, limit), ordering.create_aggregated(named))
    same(ordering.with_event_pos(named, limit), ordering.with_event_pos(named))


@pytest.mark.parametrize("limit", [25, 60])
def test_steps_between_values(spark, limit):
    source = forensic.forensic_input(audit_log(spark, SF, "user"), raw="logged_at_forensic")
    same(stages.stage_violations(source.events, limit), stages.stage_violations(source.events))
    same(
        stages.transition_counts(source.events, limit=limit),
        stages.transition_counts(source.events),
    )


def test_input_partitions_do_not_matter(spark):
    audit, rules = audit_log(spark, SF), classify.default_rules(spark)
    shuffled = audit.repartition(13, F.rand(7))
    same(log.event_log(shuffled, rules), log.event_log(audit, rules))


def scans_and_parsers(frame):
    """How often the final plan of a frame that has run reads a file and reads a time."""
    text = frame._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    return final.count("FileScan"), final.count("explode(")


@pytest.mark.parametrize("limit", [25, 10**6])
def test_building_runs_no_job_and_the_large_branch_only_if_needed(spark, tmp_path, limit):
    path = str(tmp_path / "audit")
    audit_log(spark, SF, "user").write.parquet(path)
    audit, rules = spark.read.parquet(path), classify.default_rules(spark)
    spark.sparkContext.setJobGroup(f"build-{limit}", "")
    found = log.event_log(audit, rules, limit=limit)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{limit}")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    found.collect()
    if limit > 10**5:
        # The cases have been counted; nothing is left of that and of the branch for large cases.
        assert scans_and_parsers(found) == (1, 1)
    same(found, log.event_log(audit, rules))


def test_event_positions_count_from_one(spark):
    rows = log.event_log(audit_log(spark, SF), classify.default_rules(spark)).collect()
    places = {}
    for r in rows:
        places.setdefault(r.case_id, []).append(r.event_pos)
    assert all(sorted(p) == list(range(1, len(p) + 1)) for p in places.values())
