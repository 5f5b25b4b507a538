"""Reading XES logs with Spark's XML source."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Name space and attribute keys of the format.
NAMESPACE = "http://www.xes-standard.org/"
NAME_KEY, TIME_KEY = "concept:name", "time:timestamp"

_ATTRIBUTES = T.ArrayType(
    T.StructType([T.StructField("_key", T.StringType()), T.StructField("_value", T.StringType())])
)
_EVENT = T.StructType([T.StructField("string", _ATTRIBUTES), T.StructField("date", _ATTRIBUTES)])
_TRACE = T.StructType(
    [T.StructField("string", _ATTRIBUTES), T.StructField("event", T.ArrayType(_EVENT))]
)


def _value(attributes: Column, key: str) -> Column:
    """The value of the first attribute with the key, or null."""
    return F.get(F.filter(attributes, lambda a: a["_key"] == key), F.lit(0))["_value"]


def read_xes(spark: SparkSession, path: str) -> DataFrame:
    """Read XES files as (case_id, event_pos, activity_name, timestamp_utc).

    Attributes count by their key; other attributes are skipped.
    """
    raw = (
        spark.read.format("xml")
        .option("rowTag", "trace")
        .option("ignoreSurroundingSpaces", "false")
        .schema(_TRACE)
        .load(path)
    )
    events = raw.select(
        _value(F.col("string"), NAME_KEY).alias("case_id"),
        F.posexplode("event").alias("place", "event"),
    )
    return events.select(
        "case_id",
        (F.col("place") + F.lit(1).cast("bigint")).alias("event_pos"),
        _value(F.col("event.string"), NAME_KEY).alias("activity_name"),
        _value(F.col("event.date"), TIME_KEY).alias("timestamp_utc"),
    )


# What ends a record of ``read_long_xes``.
_END_OF_EVENT = "</event>"
# Inside of a tag: quoted values may hold any character but their quote.
_INSIDE = r"""(?:[^>"']|"[^"]*"|'[^']*')*"""


# Characters that an XML parser resolves, changes or refuses in an attribute value.
_NOT_PLAIN = r"[&<\x00-\x1F\uFFFE\uFFFF]"


def _parsed_attribute(text: Column, kind: str, key: str) -> Column:
    """The value of the first attribute tag of a kind and key in a piece of XML, or null."""
    named = rf"""\bkey\s*=\s*(?:"{re.escape(key)}"|'{re.escape(key)}')"""
    tag = F.regexp_extract(text, rf"(?s)(<{kind}\s(?={_INSIDE}{named}){_INSIDE})>", 1)
    # The tag alone is a document, so a parser resolves its entities.
    alone = F.concat(F.regexp_replace(tag, r"/\z", ""), F.lit("/>"))
    return F.when(tag != "", F.xpath_string(alone, F.lit(f"/{kind}/@value")))


def _attribute(text: Column, kind: str, key: str) -> Column:
    """``_parsed_attribute``, without a parser for tags of the usual writing and plain values.

    That is so if the key stands for the first time in a tag that has its key first, its
    value next and nothing else.
    """
    before = f'<{kind} key="'
    usual = f'{before}{key}" value="'
    start = F.instr(text, usual)
    behind = F.substr(text, start + len(usual))
    value = F.substring_index(behind, '"', 1)
    end = F.substr(behind, F.length(value) + 1, F.lit(3))
    plain = (
        (start > 0) & (F.instr(text, key) == start + len(before))
        & ((end == '"/>') | F.startswith(end, F.lit('">'))) & ~F.regexp_like(value, F.lit(_NOT_PLAIN)))
    return F.when(plain, value).otherwise(_parsed_attribute(text, kind, key))


def read_long_xes(spark: SparkSession, path: str) -> DataFrame:
    """``read_xes`` for traces of any size: an event is a record, and no row holds a trace.

    Files are split at event ends, so several tasks read one trace. A window finds the
    name of the trace and the place inside each block of a file; of every block one row,
    with the last name and the events behind it, carries both on to the next block.
    Attributes of an event are between its tags and not nested; an event without any
    attribute needs an end tag. Traces without events give no rows.
    """
    # Anchored: a search would try a record without a trace again from each of its characters.
    records = spark.read.option("lineSep", _END_OF_EVENT).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.regexp_extract("value", r"(?s)\A.*<trace\b(.*?)<event\b.*", 1).alias("_head"),
        F.regexp_like("value", F.lit(r"<trace\b")).alias("opens"),
        F.regexp_extract("value", r"(?s)\A.*<event\b(.*)", 1).alias("_event"),
        F.regexp_like("value", F.lit(r"<event\b")).alias("is_event"),
    ).where("is_event")
    events = records.select(
        "file", "block", "row", "opens",
        # A trace may have no name; the struct tells that from no trace.
        F.when(F.col("opens"), F.struct(_attribute(F.col("_head"), "string", NAME_KEY).alias("name"))).alias("trace"),
        _attribute(F.col("_event"), "string", NAME_KEY).alias("activity_name"),
        _attribute(F.col("_event"), "date", TIME_KEY).alias("timestamp_utc"),
    )
    inside = Window.partitionBy("file", "block").orderBy("row")
    placed = events.withColumns({
        "trace": F.last("trace", ignorenulls=True).over(inside),
        "_row": F.row_number().over(inside),
    })
    # Rows of the block up to the one that opens the trace; null if an earlier block opened it.
    opened = F.max(F.when(F.col("opens"), F.col("_row"))).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = placed.withColumn("_opened", opened)
    ends = placed.groupBy("file", "block").agg(
        F.max_by("trace", "_row").alias("_last"), F.max("_row").alias("_rows"), F.max("_opened").alias("_at"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_total", F.sum("_rows").over(before))
    # Events of the file up to the one that opens the last trace of earlier blocks.
    start = F.max(F.coalesce("_total", F.lit(0)) + F.col("_at")).over(before)
    carried = ends.select(
        F.col("file").alias("_file"), F.col("block").alias("_block"),
        F.last("_last", ignorenulls=True).over(before).alias("_carried"),
        (F.coalesce("_total", F.lit(0)) - start + 1).alias("_behind"),
    )
    found = placed.join(carried, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    place = F.when(F.col("_opened").isNotNull(), F.col("_row") - F.col("_opened") + 1).otherwise(
        F.col("_row") + F.coalesce("_behind", F.lit(0)))
    return found.select(
        F.coalesce("trace", "_carried")["name"].alias("case_id"), place.cast("bigint").alias("event_pos"),
        "activity_name", "timestamp_utc")
