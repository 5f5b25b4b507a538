import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracewright.functions.numbers import percent, ratio, rounded
from tracewright.functions.text import WHITESPACE, clipped, contains_any, normalized, trimmed


def test_white_space_is_what_strip_removes():
    every = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
    assert set(WHITESPACE) == set(every)


def test_trim_and_normalize(spark):
    texts = ["\t a\xa0 b 　", "a\n\tb", "", " \x85 ", "plain"]
    rows = spark.createDataFrame([(x,) for x in texts], "a string")
    got = rows.select(trimmed(F.col("a")), normalized(F.col("a"))).collect()
    assert [r[0] for r in got] == [x.strip() for x in texts]
    assert [r[1] for r in got] == [" ".join(x.split()) for x in texts]


def test_clip_and_words(spark):
    rows = spark.createDataFrame([("Total_Amount" * 6,), ("abc",)], "a string")
    got = rows.select(
        clipped(F.col("a"), 50), clipped(F.col("a"), 50, "..."), contains_any(F.col("a"), ["total", "x.z"])
    ).collect()
    long = "Total_Amount" * 6
    assert got[0] == (long[:50], long[:50] + "...", True)
    assert got[1] == ("abc", "abc", False)


def _round_all(spark, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = dict(rows.select("i", rounded(F.col("v"))).collect())
    return [got[i] for i in range(len(values))]


def test_rounding_of_ties(spark):
    values = [0.075, 0.025, 0.125, 2.675, 1.005, 0.015, 0.375, -0.075, -2.5, 0.0, 33.335]
    assert _round_all(spark, values) == [round(v, 2) for v in values]


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 10**7))
def test_rounding_near_ties(spark, start):
    values = [n / 1000 for n in range(start, start + 500)]
    assert _round_all(spark, values) == [round(v, 2) for v in values]


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 10**6))
def test_rounding_of_durations(spark, start):
    values = [minutes * 60 / 86400 for minutes in range(start, start + 1000)]
    assert _round_all(spark, values) == [round(v, 2) for v in values]


def test_ratio_of_nothing(spark):
    row = spark.range(1).select(ratio(F.lit(1), F.lit(0)), percent(F.lit(1), F.lit(3))).first()
    assert row[0] is None and math.isclose(row[1], 33.33)
