import glob
import time
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from tracewright.fixtures import audit_log
from tracewright.operators import classify
from tracewright.plans.event_log import exported_events
from tracewright.sinks.xes import checked_utc, require_columns, trace_events, write_xes
from tracewright.sources.xes import NAMESPACE, read_long_xes, read_xes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return exported_events(audit_log(spark, SF), classify.default_rules(spark)).persist()


def as_rows(frame):
    columns = ["level", "case_id", "event_pos", "activity_name", "timestamp_utc"]
    return sorted(tuple(r) for r in frame.select(columns).collect())


@pytest.mark.parametrize("files", [1, 3, None])
def test_round_trip(spark, events, tmp_path, files):
    path = str(tmp_path / "log.xes")
    write_xes(events, path, files_per_level=files)
    back = None
    for level in ("L1", "L2", "L3"):
        part = read_xes(spark, f"{path}/level={level}").withColumn("level", F.lit(level))
        back = part if back is None else back.unionByName(part)
    assert as_rows(back) == as_rows(trace_events(events))


def test_files_are_plain_xes(events, tmp_path):
    path = str(tmp_path / "log.xes")
    write_xes(events, path, files_per_level=2)
    cases = []
    for file in glob.glob(f"{path}/level=L1/file=*/*.txt"):
        root = ET.parse(file).getroot()
        assert root.tag == f"{{{NAMESPACE}}}log"
        own = []
        for trace in root:
            name = trace.find(f"{{{NAMESPACE}}}string")
            assert name.get("key") == "concept:name"
            own.append(name.get("value"))
            times = [d.get("value") for d in trace.iter(f"{{{NAMESPACE}}}date")]
            assert times == sorted(times)
        assert own == sorted(set(own))
        cases += own
    wanted = {r.case_id for r in events.where("level = 'L1'").select("case_id").collect()}
    assert len(cases) == len(wanted) and set(cases) == wanted


def test_a_long_case_is_one_trace(spark, tmp_path):
    rows = spark.range(60_000).select(
        F.lit("L1").alias("level"), F.when(F.col("id") < 59_000, "long").otherwise(F.col("id").cast("string")).alias("case_id"),
        (F.col("id") + 1).alias("event_pos"), F.lit("a").alias("activity_name"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"),
    )
    path = str(tmp_path / "log.xes")
    write_xes(rows, path, files_per_level=1)
    counts = read_xes(spark, path).groupBy("case_id").count().orderBy(F.desc("count")).collect()
    assert len(counts) == 1001 and counts[0]["count"] == 59_000
    text = "".join(open(f).read() for f in glob.glob(f"{path}/level=L1/file=0/*.txt"))
    assert text.count("<trace>") == text.count("</trace>") == 1001 and "key=\"trace" not in text


def test_attributes_count_by_key(spark, tmp_path):
    file = tmp_path / "other.xes"
    file.write_text(
        f'<log xmlns="{NAMESPACE}"><trace><int key="priority" value="3"/>'
        '<string key="note" value="n"/><string key="concept:name" value="C1"/>'
        '<event><string key="concept:name" value="Act A"/><string key="org:resource" value="Bob"/>'
        '<date key="time:timestamp" value="2025-01-01T00:00:00Z"/><int key="cost" value="9"/></event>'
        '<event><string key="org:resource" value="Eve"/><date key="due" value="2026-01-01T00:00:00Z"/>'
        '<date key="time:timestamp" value="2025-01-02T00:00:00Z"/></event></trace></log>'
    )
    rows = read_xes(spark, str(file)).orderBy("event_pos").collect()
    assert [tuple(r) for r in rows] == [
        ("C1", 1, "Act A", "2025-01-01T00:00:00Z"), ("C1", 2, None, "2025-01-02T00:00:00Z")]


def test_markup_and_blanks_survive(spark, audit, tmp_path):
    rules = classify.default_rules(spark)
    log = audit(
        ("A & <1>", "U", "stepname", "", "1/1/2025 1:00"),
        ("A & <1>", "U", "statecode", "\"quoted\" 'text' → ü", "1/1/2025 2:00"),
    )
    path = str(tmp_path / "log.xes")
    write_xes(exported_events(log, rules), path)
    rows = read_xes(spark, path).orderBy("event_pos").collect()
    assert [tuple(r) for r in rows] == [
        ("A & <1>", 1, "stepname → ", "2025-01-01T01:00:00Z"),
        ("A & <1>", 2, "statecode → \"quoted\" 'text' → ü", "2025-01-01T02:00:00Z"),
    ]


def test_required_columns(events):
    with pytest.raises(ValueError, match="level"):
        trace_events(events.drop("level"))
    require_columns(events, "case_id")


def test_bad_utc_text_fails_the_job(spark):
    rows = spark.createDataFrame(
        [("1", "a", "2025-01-01T00:00:00Z"), ("2", "b", "2025-01-01 00:00")],
        "case_id string, activity_name string, timestamp_utc string",
    )
    assert checked_utc(rows.limit(1)).count() == 1
    with pytest.raises(Exception, match="not a strict UTC time: 2025-01-01 00:00 in case 2"):
        checked_utc(rows).collect()


HAND_MADE = """<?xml version="1.0" encoding="UTF-8"?>
<log xes.version="1.0"><string key="concept:name" value="the log"/>
<trace><string key="concept:name" value="a &amp; &#60;b&gt;"/><int key="n" value="1"/>
  <event><string key="org:resource" value="x>y"/><string value='say "hi"' key='concept:name'/>
    <date key="time:timestamp" value="2025-01-01T00:00:00Z"/></event>
  <event ><date key="time:timestamp" value="2025-01-01T00:00:01Z"></date></event></trace>
<trace><string key="concept:name" value="no events"/></trace>
<trace ><event><string key="concept:name" value="unnamed trace"/></event>
</trace><trace><string key="other" value="o"/><string key="concept:name" value="last"/><event></event>
<event><string key="concept:name" value="&#228;&#x20AC;"/></event></trace>
</log>
"""


def test_events_as_records(spark, tmp_path):
    (tmp_path / "log.xes").write_text(HAND_MADE, encoding="utf-8")
    found = sorted((tuple(r) for r in read_long_xes(spark, str(tmp_path / "log.xes")).collect()), key=repr)
    assert found == sorted((tuple(r) for r in read_xes(spark, str(tmp_path / "log.xes")).collect()), key=repr)
    assert ("a & <b>", 1, 'say "hi"', "2025-01-01T00:00:00Z") in found and ("last", 2, "ä€", None) in found
    assert (None, 1, "unnamed trace", None) in found and len(found) == 5


@pytest.mark.parametrize("block", [3_000, 70_000])
def test_a_trace_over_many_blocks(spark, tmp_path, block):
    """Blocks without a trace start, and blocks with several."""
    rows = spark.range(9_000).select(
        F.lit("L1").alias("level"),
        F.when(F.col("id") < 6_000, "long").otherwise((F.col("id") / 7).cast("int").cast("string")).alias("case_id"),
        (F.col("id") + 1).alias("event_pos"), F.concat(F.lit("a"), F.col("id")).alias("activity_name"),
        F.lit("2025-01-01 00:00:00").cast("timestamp_ntz").alias("ts"))
    path = str(tmp_path / "log.xes")
    write_xes(rows, path, files_per_level=1)
    wanted = sorted(tuple(r) for r in read_xes(spark, path).select("case_id", "event_pos", "activity_name").collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        found = read_long_xes(spark, path)
        parts = spark.read.text(path).rdd.getNumPartitions()
        got = sorted(tuple(r) for r in found.select("case_id", "event_pos", "activity_name").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert parts > 9 and got == wanted and len(got) == 9_000


ODD_TAGS = """<log><trace><string key="note" value="concept:name"/><string key='concept:name' value='c'/>
<event><string key="other" value="concept:name"/><string key="concept:name" value="late"/></event>
<event><string value="x" key="concept:name"/><date key="time:timestamp" value=""/></event>
<event><string key="concept:name" value="a &amp; b" /><date key="time:timestamp" value="t"></date></event>
<event><string key="concept:name" value="two
lines"/><date key="time:timestamp" value="u" more="v"/></event>
<event><string key="concept:name" value="it's > →"/><string key="concept:name" value="second"/></event></trace></log>
"""


def test_usual_and_other_tags_read_alike(spark, tmp_path):
    (tmp_path / "odd.xes").write_text(ODD_TAGS, encoding="utf-8")
    found = sorted((tuple(r) for r in read_long_xes(spark, str(tmp_path / "odd.xes")).collect()), key=repr)
    assert found == sorted((tuple(r) for r in read_xes(spark, str(tmp_path / "odd.xes")).collect()), key=repr)
    assert found == [("c", 1, "late", None), ("c", 2, "x", ""), ("c", 3, "a & b", "t"), ("c", 4, "two lines", "u"),
                     ("c", 5, "it's > →", None)]


def test_records_without_a_trace_are_searched_once(spark, tmp_path):
    """A search from every character of a long event behind the first takes the square of its length."""
    long = "y" * 150_000
    (tmp_path / "long.xes").write_text(
        '<log><trace><string key="concept:name" value="c"/><event><date key="d" value="1"/></event>'
        + f'<event><string key="concept:name" value="{long}"/></event>' * 4 + "</trace></log>")
    begun = time.monotonic()
    found = read_long_xes(spark, str(tmp_path / "long.xes")).where("event_pos > 1").collect()
    assert len(found) == 4 and {r.activity_name for r in found} == {long}
    assert time.monotonic() - begun < 20
