import random
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tracewright.functions import timestamps as t

TEXTS = [
    # ISO, valid and not
    "2025", "2025-08", "10:30", "2025-08-15", "20250815", "2025-08-15T10", "2025-08-15T10:30",
    "2025-08-15 10:30:15", "2025-08-15T10:30:15.123456", "2025-08-15T10:30:15,5",
    "20250815T1030", "20250815T103015", "20250815T103015Z", "20250815T10", "2025-08-15T1030",
    "2025-0815", "2025-08-15Z", "20250815Z", "2025-08-15T10:30Z", "2025-08-15T10Z",
    "2025-08-15T10:30:15+05:30", "2025-08-15T10:30:15-0530", "2025-08-15T10:30:15-05",
    "2025-08-15T10:30+05:30:15", "2025-08-15+05:30", "2025-08-15-05:30", "2025-02-30",
    "0000-01-01", "2025-13-01T00:00", "2025-08-15T25:00", "2025-08-15T10:60", "2025-8-5",
    "2025-08-15T10:30:15.", "2025-08-15T10:30:15z", "2025-08-15T10:3", "2025-08-15x10:30",
    "0001-01-01", "2025-08-15T10:30:61", "2025-08-15T10:30+00:00", "20250815T103015.5+0100",
    # digit widths and blanks
    "007/10/2025 11:18", "7/10/25 9:05", "7/10/2025  11:18", "7/10/2025\t11:18",
    "1/2/2025\xa010:30", "1/2/2025 10:5", "1/2/2025 1:2:3", "2025/1/2 3:4:5", "2025/1/2 3:4",
    "1/ 5/25 10:00", "12/ 5/2025 10:00", " 5/12/2025 10:00 ",
    # two-digit years, impossible dates, ambiguous days
    "5/1/69 1:00", "5/1/68 1:00", "31/02/2024 10:00", "29/02/2024 10:00", "29/02/2023 10:00",
    "2/12/25 10:30", "1/29/26 0:00", "29/1/26 0:00", "1/2/2025 10:30:60",
    # halves of the day
    "12/12/2025 12:05 AM", "12/12/2025 12:05 pm", "1/2/2025 1:05 PM", "1/2/2025 11:05:09 Pm",
    "1/2/2025 13:05 PM", "1/2/2025 00:05 AM",
    # clock changes
    "2025-03-09 02:30", "2025-03-09T02:30:00", "9/3/2025 2:30", "2025-11-02 01:30",
    # nothing
    "", "  ", "null", "NULL", "Null ", "garbage", "1,2,3",
]


def expected_utc(text, zone):
    text = text.strip()
    if text.lower() in ("", "null"):
        return None
    moment = None
    try:
        moment = datetime.fromisoformat(text[:-1] + "+00:00" if text.endswith("Z") else text)
    except ValueError:
        for fmt in t.PIPELINE_FORMATS:
            try:
                moment = datetime.strptime(text, fmt)
                break
            except ValueError:
                pass
    if moment is None:
        return None
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=ZoneInfo(zone))
    return moment.astimezone(timezone.utc).replace(microsecond=0, tzinfo=None).isoformat()


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_utc_parser_follows_the_standard_library(spark, zone, session_zone):
    rows = spark.createDataFrame([(x,) for x in TEXTS], "text string")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        moment = t.parsed(F.col("text"), t.utc_parser(timezone=zone))
        got = dict(rows.select("text", t.iso_local(moment)).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == {x: expected_utc(x, zone) for x in TEXTS}


def odd_text(rng):
    def number(high):
        return f"{rng.randint(0, high):0{rng.choice((1, 1, 2, 2, 3))}d}"

    year = rng.choice((number(99), f"20{rng.randint(0, 99):02d}", "1999", "20250"))
    parts = [number(33), number(14), year]
    rng.shuffle(parts) if rng.random() < 0.3 else None
    clock = ":".join(number(62) if i else number(25) for i in range(rng.choice((1, 2, 2, 3))))
    blank = rng.choice((" ", " ", " ", " ", "  ", "\t", "T", ""))
    return rng.choice(("/", "/", "/", "-")).join(parts) + blank + clock + rng.choice(
        ("", "", "", " AM", " pm", "PM", "Z", "+01:00")
    )


def test_odd_texts_follow_the_standard_library(spark):
    rng = random.Random(11)
    texts = sorted({odd_text(rng) for _ in range(20000)})
    rows = spark.createDataFrame([(x,) for x in texts], "text string")
    got = rows.select("text", t.iso_local(t.parsed(F.col("text"), t.utc_parser()))).collect()
    expected = {x: expected_utc(x, "UTC") for x in texts}
    assert sum(v is not None for v in expected.values()) > 300
    assert dict(got) == expected


def test_forensic_formats_read_short_years_day_first(spark):
    texts = ["2/12/25 10:30", "1/29/26 0:00", "27/10/2025 11:18", "2025-08-15T10:30", "7/10/25 10:45"]
    rows = spark.createDataFrame([(x,) for x in texts], "text string")
    got = rows.select("text", t.iso_local(t.parsed(F.col("text"), t.local_parser()))).collect()
    assert dict(got) == {
        "2/12/25 10:30": "2025-12-02T10:30:00",
        "1/29/26 0:00": "2026-01-29T00:00:00",
        "27/10/2025 11:18": "2025-10-27T11:18:00",
        "2025-08-15T10:30": None,
        "7/10/25 10:45": "2025-10-07T10:45:00",
    }


def test_a_later_format_gets_dates_an_earlier_one_cannot_hold(spark):
    rows = spark.createDataFrame([("25/02/30",)], "text string")
    parser = t.local_parser(["%y/%m/%d", "%d/%m/%y"])
    assert rows.select(t.iso_local(t.parsed(F.col("text"), parser))).first()[0] == "2030-02-25T00:00:00"


def test_readable_drops_what_parsed_leaves_null(spark):
    rows = spark.createDataFrame([(x,) for x in TEXTS], "text string")
    parser = t.utc_parser()
    kept = rows.select("text", F.explode(t.readable(F.col("text"), parser)).alias("ts"))
    valid = rows.select("text", t.parsed(F.col("text"), parser).alias("ts")).where("ts is not null")
    assert sorted(kept.collect()) == sorted(valid.collect())


def test_drop_reasons(spark):
    rows = spark.createDataFrame([(x,) for x in ["", " ", "NULL", None, "x", "1/1/2025 1:00"]], "a string")
    parsed = t.parsed(F.col("a"), t.utc_parser())
    got = [r[0] for r in rows.select(t.drop_reason(F.col("a"), parsed)).collect()]
    assert got == [t.MISSING] * 4 + [t.INVALID, None]


def test_strict_utc(spark):
    good = ["2025-08-15T14:51:00Z", "2025-08-15T14:51:00.25Z"]
    bad = [
        " 2025-08-15T14:51:00Z", "2025-08-15T14:51:00", "2025-08-15 14:51:00Z",
        "2025-02-30T14:51:00Z", "2025-08-15T14:51:00+00:00", "2025-08-15T24:51:00Z",
        "2025-08-15T14:51:00Z\n", None, "",
    ]
    rows = spark.createDataFrame([(x,) for x in good + bad], "a string")
    got = [r[0] for r in rows.select(t.is_strict_utc(F.col("a"))).collect()]
    assert got == [True] * len(good) + [False] * len(bad)


def test_shapes(spark):
    texts = ["27/10/2025 11:18", "7/10/25 10:45", "17/1/25 10:45", "12/10/25 9:59", "nothing"]
    rows = spark.createDataFrame([(x,) for x in texts], "a string")
    got = [r[0] for r in rows.select(t.shape_label(F.col("a"))).collect()]
    assert got == ["DD/MM/YYYY HH:MM", "D/M/YY HH:MM", "D/M/YY HH:MM", "other", "other"]


def test_seconds_between_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = spark.sql(
            "select timestamp_ntz'2025-03-09 01:00:00' a, timestamp_ntz'2025-03-10 02:30:10' b"
        )
        assert rows.select(t.seconds_between(F.col("a"), F.col("b"))).first()[0] == 91810
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_iso_week_dates(spark):
    """As the standard library reads them."""
    rng = random.Random(9)
    texts = ["2024-W05-3T10:00:00Z", "2024W053T1000", "2024-W05", "2024W05", "2024-W05-10:30", "2024-W05-3 10:30+05:30",
             "2020-W53-7", "2021-W53-1", "2021-W00-1", "2021-W54-1", "2021-W01-0", "2021-W01-8", "2021W018", "2021-W1-1",
             "0001-W01-1", "9999-W52-7", "0000-W10-1", "2024-W05-", "2024-W05Z", "2024-W05-3Z", "2024-w05-3", "2024W05-3"]
    texts += [f"{rng.randrange(1, 9999):04}-W{rng.randrange(1, 54):02}-{rng.randrange(1, 8)}" for _ in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = rows.select("t", t.parsed(F.col("t"), t.utc_parser()).alias("ts")).collect()
    for text, moment in found:
        want = None
        try:
            want = datetime.fromisoformat(text[:-1] + "+00:00" if text.endswith("Z") else text)
            want = want.astimezone(timezone.utc).replace(tzinfo=None) if want.tzinfo else want
        except ValueError:
            pass
        assert moment == want, text
