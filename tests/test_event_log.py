import pytest

from tracewright.operators import classify, events as ev, ordering
from tests.test_reports import scans_that_ran
from tracewright.fixtures import audit_log
from tracewright.plans import event_log as plans
from tracewright.plans.event_log import (
    event_log, event_log_of, exported_events, step_counts, timed_events,
)
from tracewright.plans.forensic import abandoned_cases
from tracewright.functions.timestamps import utc_parser


def names(frame):
    ordered = ordering.in_canonical_order(ordering.with_create_flag(frame))
    return [r.activity_name for r in ordered.collect()]


@pytest.fixture(scope="module")
def rules(spark):
    return classify.default_rules(spark)


@pytest.fixture(params=[5_000_000, 1], ids=["ordinary", "large"])
def limit(request):
    return request.param


def test_names_by_bucket(spark, audit, rules):
    log = audit(
        ("1", "Update", "StateCode", "1", "1/1/2025 1:00"),
        ("1", "Update", "statuscode", "9", "1/1/2025 2:00"),
        ("1", "Update", "DevelopProposal", "TRUE", "1/1/2025 3:00"),
        ("1", "Update", "purchaseprocess", "2", "1/1/2025 4:00"),
        ("1", "Update", "OwnerId", "x", "1/1/2025 5:00"),
        ("1", "Update", "customerid", "x", "1/1/2025 6:00"),
        ("1", "Update", "ExchangeRate", "2", "1/1/2025 7:00"),
        ("1", "Update", "mystery", "3", "1/1/2025 8:00"),
        ("1", "Update", "stepname", "", "1/1/2025 9:00"),
        ("1", "Update", "exchangerate", "2", "1/1/2025 10:00"),
    )
    out = event_log(log, rules)
    assert names(out) == [
        "StateCode → Won", "statuscode → 9", "DevelopProposal completed", "purchaseprocess → 2",
        "Owner changed", "customerid changed", "ExchangeRate → 2", "mystery → 3", "stepname → ",
    ]
    levels = {r.field: (r.bucket, r.level) for r in out.collect()}
    assert levels["ExchangeRate"] == ("KILL_NOISE", "KILL")
    assert levels["mystery"] == ("UNKNOWN", "UNKNOWN")
    exported = exported_events(log, rules)
    assert {r.field for r in exported.collect()}.isdisjoint({"ExchangeRate", "mystery"})


def test_single_events_are_judged_before_other_filters(audit, rules, limit):
    log = audit(
        ("1", "Update", "exchangerate", "1", "1/1/2025 1:00"),
        ("1", "Update", "ownerid", "1", "1/1/2025 1:00"),
        ("2", "Update", "ownerid", "1", "1/1/2025 1:00"),
        ("2", "Update", "ownerid", "1", "never"),
        ("3", "Update", "exchangerate", "1", "1/1/2025 1:00"),
        ("3", "Update", "exchangerate", "2", "1/1/2025 1:00"),
    )
    assert [r.case_id for r in event_log(log, rules, limit=limit).collect()] == ["1"]
    removed = ev.single_event_rows(timed_events(log))
    assert [(r.case_id, r.ingest_ord) for r in removed.collect()] == [("2", 2)]


def test_creates_collapse_to_the_earliest(audit, rules, limit):
    log = audit(
        ("1", "Create", "stepname", "16-Propose", "1/1/2025 2:00"),
        ("1", "Create", "stepname", "15-Develop", "1/1/2025 3:00"),
        ("1", "Create", "ownerid", "x", "1/1/2025 2:00"),
        ("1", "create", "ownerid", "x", "1/1/2025 1:00"),
        ("2", "Create", "ownerid", "x", "1/1/2025 2:00"),
        ("2", "Create", "stepname", "14-Qualify", "1/1/2025 2:00"),
        ("2", "Update", "ownerid", "x", "1/1/2025 2:00"),
    )
    rows = event_log(log, rules, limit=limit).orderBy("ingest_ord").collect()
    got = [(r.ingest_ord, r.activity_name, r.sequence, r.level) for r in rows]
    assert got == [
        (0, "Case Created", 15, "L1"),
        (3, "Owner changed", None, "L3"),
        (4, "Case Created", None, "L3"),
        (6, "Owner changed", None, "L3"),
    ]


def test_order_inside_one_instant(audit, rules):
    at = "1/1/2025 1:00"
    log = audit(
        ("1", "Update", "ownerid", "x", at),
        ("1", "Update", "stepname", "16-Propose", at),
        ("1", "Update", "stepname", "9-First", at),
        ("1", "Update", "statuscode", "1", at),
        ("1", "Create", "statecode", "0", at),
        ("1", "Update", "customerid", "x", "1/1/2025 0:30"),
    )
    assert names(event_log(log, rules)) == [
        "customerid changed", "statuscode → In Progress", "stepname → 9-First",
        "stepname → 16-Propose", "Case Created", "Owner changed",
    ]


def test_first_copy_in_canonical_order_survives(audit, rules, limit):
    log = audit(
        ("1", "Update", "ownerid", "b", "1/1/2025 1:00"),
        ("1", "Update", "ownerid", "a", "2025-01-01T01:00:00Z"),
        ("1", "Update", "ownerid", "c", "1/1/2025 1:01"),
        ("2", "Update", "ownerid", "c", "1/1/2025 1:00"),
        ("2", "Update", "OWNERID", "c", "1/1/2025 1:00"),
    )
    rows = event_log(log, rules, limit=limit).collect()
    assert sorted(r.ingest_ord for r in rows) == [0, 2, 3]


def test_case_keys_are_normalised(audit, rules):
    log = audit(
        ("\tITEM \xa0 1 ", "Update", "ownerid", "b", "1/1/2025 1:00"),
        ("ITEM 1", "Update", "ownerid", "a", "1/1/2025 2:00"),
    )
    assert {r.case_id for r in event_log(log, rules).collect()} == {"ITEM 1"}


def test_step_counts_match_the_steps(spark, audit, rules, limit):
    log = audit(
        ("1", "Create", "ownerid", "x", "1/1/2025 1:00"),
        ("1", "Create", "statecode", "0", "1/1/2025 1:00"),
        ("1", "Update", "exchangerate", "0", "1/1/2025 1:00"),
        ("1", "Update", "customerid", "0", "1/1/2025 1:00"),
        ("1", "Update", "customerid", "1", "1/1/2025 1:00"),
        ("2", "Update", "customerid", "1", "1/1/2025 1:00"),
        ("2", "Update", "customerid", "1", "oops"),
    )
    assert dict(step_counts(log, rules, limit=limit).collect()) == {
        "rows_loaded": 7, "rows_with_time": 6, "cases_removed": 1, "rows_multi_event": 5,
        "rows_without_noise": 4, "rows_with_sequence": 0, "rows_creates_collapsed": 3,
        "distinct_activities": 3, "rows_deduplicated": 2,
    }


def test_empty_input(spark, audit, rules):
    log = audit(("1", "Update", "ownerid", "x", "never"))
    assert event_log(log, rules).count() == 0
    assert dict(step_counts(log, rules).collect())["rows_loaded"] == 1


def test_quarantine(audit):
    log = audit(
        ("1", "U", "f", "v", " null "), ("1", "U", "f", "v", "soon"),
        ("1", "U", "f", "v", "1/1/2025 1:00"),
    )
    bad = ev.invalid_time(log, utc_parser()).orderBy("ingest_ord").collect()
    assert [r.drop_reason for r in bad] == ["DROP_TIMESTAMP_MISSING", "DROP_TIMESTAMP_INVALID"]


def test_kill_filter_spelling(audit, rules):
    log = audit(
        ("1", "U", "exchangerate", "", ""), ("1", "U", "ExchangeRate", "", ""),
        ("1", "U", None, "", ""),
    )
    assert classify.without_kill_fields(log, rules).count() == 2
    assert classify.without_kill_fields(log, rules, case_insensitive=True).count() == 1


def test_own_rules(spark, audit):
    rules = classify.Rules(
        classify.bucket_rules(
            spark, {"L1_STAGE": ["Phase"], "L3_ADMIN": ["phase", "who"]}, labels={"who": "Handed over"}
        ),
        classify.code_rules(spark, {"Phase": {"1": "Begin"}}),
        (),
    )
    log = audit(("1", "U", "PHASE", "1", "1/1/2025 1:00"), ("1", "U", "who", "x", "1/1/2025 2:00"))
    assert names(event_log(log, rules)) == ["PHASE → Begin", "Handed over"]


def test_rule_keys_must_be_unique(spark):
    with pytest.raises(ValueError, match="twice"):
        classify.rule_table(spark, ("field", "bucket"), 1, [("a", "x"), ("a", "y")])


def test_the_first_rule_of_a_key_counts(spark):
    table = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("b", "z", 3)], "field string, bucket string, rule_order int")
    assert sorted(tuple(r)[:2] for r in classify.first_rules(table, ["field"]).collect()) == [("a", "y"), ("b", "z")]
    plain = table.drop("rule_order").coalesce(1)
    assert sorted(map(tuple, classify.first_rules(plain, ["field"]).collect())) == [("a", "x"), ("b", "z")]


def test_every_default_field_has_one_bucket():
    every = [f for fields in classify.BUCKET_FIELDS.values() for f in fields]
    assert len(every) == len(set(every)) == 63


def test_sequence_needs_the_stage_field(spark, audit):
    log = audit(
        ("1", "U", "StepName", "14-Qualify", ""), ("1", "U", "stepname", "x14-", ""),
        ("1", "U", "other", "14-Qualify", ""), ("1", "U", "stepname", "007-a", ""),
    )
    rows = classify.sequenced(log).orderBy("ingest_ord").collect()
    assert [r.sequence for r in rows] == [14, None, None, 7]


def test_log_of_named_sources(spark, audit):
    log = audit(("1", "U", "ownerid", "x", "1/1/2025 1:00"), ("1", "U", "statecode", "1", "1/1/2025 2:00"))
    rules = classify.default_rules(spark)
    wanted = names(event_log(log, rules))
    assert names(event_log_of({"audit_log": log}, rules)) == wanted
    raw = log.selectExpr(
        "case_key as `Item ID`", "operation as Operation", "field as Field", "old_value as `Old value`",
        "new_value as `New value`", "actor as `Anon Actor`", "logged_at as `Date logged`")
    assert names(event_log_of({"audit_log": raw, "main_case_table": log}, rules)) == wanted
    with pytest.raises(ValueError, match="audit_log"):
        event_log_of({"activity_table": log}, rules)


@pytest.mark.parametrize("limit", [4, 10**6])
def test_log_removed_cases_and_counts_from_one_job(spark, rules, tmp_path, limit):
    audit, path = audit_log(spark, "/root/testdata/sf0.001"), str(tmp_path / "clean")
    counts = plans.clean(audit, rules, path, limit=limit)
    wanted = {r.step: r.rows for r in step_counts(audit, rules).collect()}
    # No bounded observer holds all names.
    assert wanted.pop("distinct_activities") > 0 and counts == wanted
    for found, direct in (
        (plans.cleaned_log(spark, path), event_log(audit, rules)),
        (plans.removed_cases(spark, path), abandoned_cases(audit)),
    ):
        columns = sorted(direct.columns)
        assert sorted(found.columns) == columns
        assert found.select(columns).exceptAll(direct.select(columns)).isEmpty()
        assert found.count() == direct.count()


def test_cleaning_reads_and_parses_once(spark, rules):
    rows = plans.cleaned_rows(audit_log(spark, "/root/testdata/sf0.001"), rules)
    rows.collect()
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert scans_that_ran(rows) == 1 and text.split("== Initial Plan ==")[0].count("explode(") == 1


def test_cleaning_nothing(spark, rules, tmp_path):
    audit = audit_log(spark, "/root/testdata/sf0.001").limit(0)
    counts = plans.clean(audit, rules, str(tmp_path / "clean"))
    assert set(counts.values()) == {0} and len(counts) == 8
