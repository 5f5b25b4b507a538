import pytest
from pyspark.sql import functions as F

from tracewright.operators.classify import default_rules
from tracewright.plans.event_log import event_log
from tests.test_plans import plan
from tracewright.sinks.tables import write_event_log
from tracewright.sources.audit import (
    audit_rows, event_sources, file_ranks, read_audit_csv, read_bad_lines, resolve_columns,
)

HEADER = ["Anon Item ID", "Operation", "Field", "Previous value", "New value", "Anon Actor", "Date logged"]


def test_roles_by_exact_name_first():
    roles = resolve_columns(HEADER)
    assert roles["case_id"] == "Anon Item ID" and roles["timestamp"] == "Date logged"


def test_roles_by_loose_name():
    names = ["﻿item  id", "ACTION", "field-name", "OldValue", "new_value", "date_logged"]
    assert resolve_columns(names) == {
        "timestamp": "date_logged", "case_id": "﻿item  id", "field": "field-name",
        "previous_value": "OldValue", "new_value": "new_value", "operation": "ACTION",
    }


def test_alias_order_decides():
    assert resolve_columns(["Date", "Timestamp", *HEADER])["timestamp"] == "Timestamp"


def test_timestamp_fallback_needs_a_single_candidate():
    names = [*HEADER[:-1], "Actor Date Log"]
    assert resolve_columns(names)["timestamp"] == "Actor Date Log"
    with pytest.raises(ValueError, match="timestamp"):
        resolve_columns([*names, "Date of login"])


def test_missing_roles_are_listed():
    with pytest.raises(ValueError, match=r"case_id.*operation"):
        resolve_columns(["Field", "Timestamp", "Old value", "New value"])


def test_csv_scan(spark, tmp_path):
    text = (
        "﻿Anon Item ID,Operation,Field,Previous value, New  value ,Anon Actor,Date logged,Note\n"
        ' ITEM-1 ,Update,ownerid,NA,"a ""b"",\nc",ACTOR-1,7/10/25 10:45,x\n'
        "ITEM-2,Create,statecode,,null, ACTOR-2,,\n"
    )
    path = tmp_path / "audit.csv"
    path.write_text(text, encoding="utf-8")
    rows = read_audit_csv(spark, str(path), multi_line=True).orderBy("ingest_ord").collect()
    first, second = rows[0].asDict(), rows[1].asDict()
    assert first.pop("ingest_ord") < second.pop("ingest_ord")
    assert first == {
        "case_key": "ITEM-1", "operation": "Update", "field": "ownerid", "old_value": "",
        "new_value": 'a "b",\nc', "actor": "ACTOR-1", "logged_at": "7/10/25 10:45", "Note": "x",
    }
    assert second["new_value"] == "" and second["logged_at"] == "" and second["actor"] == "ACTOR-2"
    kept = read_audit_csv(spark, str(path), nulls="keep", multi_line=True).orderBy("ingest_ord").collect()[1]
    assert kept["logged_at"] is None and kept["old_value"] == "" and kept["Note"] is None


def test_several_files_are_ordered_by_file(spark, tmp_path):
    for name, cases in (("b", ["3"]), ("a", ["1", "2"])):
        lines = [",".join(HEADER), *(f"{c},Update,f,,v,A,1/1/2025 1:00" for c in cases)]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    rows = read_audit_csv(spark, str(tmp_path)).orderBy("ingest_ord").select("case_key").collect()
    assert [r[0] for r in rows] == ["1", "2", "3"]


def test_files_with_headers_of_their_own(spark, tmp_path):
    (tmp_path / "a 1.csv").write_text(",".join(HEADER) + "\nI1,Update,f,o,v,A,1/1/2025 1:00\n")
    (tmp_path / "b.csv").write_text(
        "Date logged,New value,Previous value,Field,Operation,Anon Item ID\r\n27/10/2025 11:18,n,p,g,Create,I2\r\n")
    (tmp_path / "c.csv").write_text("\ufeff" + ",".join([*HEADER, "Note"]) + "\nI3,Update,f,,,B,2/1/2025 1:00,x\n")
    (tmp_path / "d.csv").write_text("")
    rows = read_audit_csv(spark, str(tmp_path)).orderBy("ingest_ord")
    assert dict(rows.dtypes)["ingest_ord"] == "bigint"
    assert [(r.case_key, r.operation, r.field, r.old_value, r.new_value, r.actor, r.logged_at, r.Note)
            for r in rows.collect()] == [
        ("I1", "Update", "f", "o", "v", "A", "1/1/2025 1:00", None),
        ("I2", "Create", "g", "p", "n", None, "27/10/2025 11:18", None),
        ("I3", "Update", "f", "", "", "B", "2/1/2025 1:00", "x"),
    ]
    out = str(tmp_path / "out")
    write_event_log(event_log(rows, default_rules(spark)), out, "csv")
    assert spark.read.option("header", True).csv(out).count() == 0  # three cases of one event each


def test_same_headers_are_read_once_and_checked(spark, tmp_path):
    for name, case in (("b", "2"), ("a", "1")):
        (tmp_path / f"{name}.csv").write_text(",".join(HEADER) + f"\n{case},Update,f,,v,A,1/1/2025 1:00\n")
    rows = read_audit_csv(spark, str(tmp_path), headers="same").orderBy("ingest_ord").collect()
    assert [r.case_key for r in rows] == ["1", "2"]
    (tmp_path / "c.csv").write_text(",".join(reversed(HEADER)) + "\n1/1/2025 1:00,A,v,,f,Update,3\n")
    with pytest.raises(Exception, match="header"):
        read_audit_csv(spark, str(tmp_path), headers="same").collect()
    with pytest.raises(ValueError, match="headers"):
        read_audit_csv(spark, str(tmp_path), headers="none")


def test_large_files_are_split_in_order(spark, tmp_path):
    lines = [f"C{i},Update,f,,v{i},A,1/1/2025 1:00" for i in range(20_000)]
    for name, part in (("x", lines[:12_000]), ("y", lines[12_000:])):
        (tmp_path / f"{name}.csv").write_text("\n".join([",".join(HEADER), *part]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        rows = read_audit_csv(spark, str(tmp_path)).orderBy("ingest_ord").select("case_key").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r[0] for r in rows] == [f"C{i}" for i in range(20_000)]


def test_broken_lines(spark, tmp_path):
    good = "I{},Update,f,,v,A,1/1/2025 1:00"
    lines = [",".join(HEADER), good.format(1), "I2,Update", good.format(3) + ",more", '"I4,Update,f,,v,A,1/1/2025 1:00',
             "", good.format(5)]
    (tmp_path / "a b.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "c.csv").write_text(",".join(reversed(HEADER)) + "\n1/1/2025 1:00,A,v,,f,Update,I6\nI7\n")
    rows = read_audit_csv(spark, str(tmp_path), bad_lines="drop").orderBy("ingest_ord")
    assert [r.case_key for r in rows.collect()] == ["I1", "I5", "I6"]
    # Also if only some columns are wanted.
    assert [r[0] for r in rows.select("case_key").collect()] == ["I1", "I5", "I6"] and rows.count() == 3
    bad = read_bad_lines(spark, str(tmp_path)).orderBy("ingest_ord").collect()
    assert [r.line for r in bad] == [lines[2], lines[3], lines[4], "I7"]
    assert [r.file.rsplit("/", 1)[1] for r in bad] == ["a%20b.csv"] * 3 + ["c.csv"]
    kept = read_audit_csv(spark, str(tmp_path), bad_lines="keep").collect()
    assert {r.case_key for r in kept} >= {"I1", "I2", "I3", "I5", "I6"} and len(kept) == 7
    with pytest.raises(Exception, match="broken line in .*a%20b.csv: I2,Update"):
        read_audit_csv(spark, str(tmp_path / "a b.csv")).collect()
    with pytest.raises(ValueError, match="bad_lines"):
        read_audit_csv(spark, str(tmp_path), bad_lines="skip")
    # Rows and broken lines are all lines in their order.
    every = sorted([(r.ingest_ord, r.case_key) for r in rows.collect()] + [(r.ingest_ord, r.line) for r in bad])
    assert [x for _, x in every] == ["I1", *lines[2:5], "I5", "I6", "I7"]


def test_broken_lines_of_one_header(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text(",".join(HEADER) + f"\n{name},Update,f,,v,A,1/1/2025 1:00\n{name}\n")
    rows = read_audit_csv(spark, str(tmp_path), headers="same", bad_lines="drop").orderBy("ingest_ord")
    assert [r.case_key for r in rows.collect()] == ["a", "b"]
    assert [r.line for r in read_bad_lines(spark, str(tmp_path), headers="same").collect()] == ["a", "b"]
    # One pass over the files, the names by a join.
    text = plan(read_audit_csv(spark, str(tmp_path), headers="same"))
    assert text.count("FileScan csv") == 1 and "BroadcastHashJoin" in text


def test_any_number_of_files(spark):
    files = [f"file:/x/{i:06}.csv" for i in range(70_000)]
    ranks = file_ranks(spark, files, 1 << 30).orderBy("_file").collect()
    starts = [r._start for r in ranks]
    assert starts[0] == 0 and all(b - a == 1 << 41 for a, b in zip(starts, starts[1:]))
    with pytest.raises(ValueError, match="place numbers"):
        file_ranks(spark, files, 1 << 50)
    few = file_ranks(spark, files[:3]).collect()
    assert sorted(r._start for r in few) == [0, 1 << 48, 2 << 48]


def test_null_policy_is_checked(spark):
    table = spark.createDataFrame([("",) * 7], HEADER)
    with pytest.raises(ValueError, match="nulls"):
        audit_rows(table, nulls="drop")


def test_a_given_order_is_kept(spark):
    table = spark.createDataFrame([(*"abcdefg", 7)], [*HEADER, "id"])
    row = audit_rows(table, ingest_ord=F.col("id")).first()
    assert row["ingest_ord"] == 7 and row["id"] == 7


def test_source_contract(spark):
    table = spark.createDataFrame([("",) * 7], HEADER)
    assert event_sources({"audit_log": table}) is table
    with pytest.raises(ValueError, match="no event source"):
        event_sources({"main_case_table": table})
    with pytest.raises(ValueError, match="audit_log"):
        event_sources({"activity_table": table})
    with pytest.raises(ValueError, match="unknown"):
        event_sources({"audit_log": table, "other": table})
    with pytest.raises(ValueError, match="timestamp"):
        event_sources({"audit_log": table.drop("Date logged")})
