"""XES logs as text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timestamps import is_strict_utc, iso_utc
from ..operators.classify import EXPORT_LEVELS
from ..sources.xes import NAME_KEY, NAMESPACE, TIME_KEY

# Characters that XML attributes write as entities, the ampersand first.
XML_ENTITIES = {
    "&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;", "\t": "&#9;", "\n": "&#10;", "\r": "&#13;",
}


def require_columns(table: DataFrame, *names: str) -> None:
    """Fail early when a column is missing."""
    missing = [name for name in names if name not in table.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {table.columns}")


def trace_events(events: DataFrame, *more: str) -> DataFrame:
    """The events of the exported levels with the attributes that XES shows, and further columns."""
    require_columns(events, "level", "case_id", "event_pos", "activity_name", "ts")
    return events.where(F.col("level").isin(*EXPORT_LEVELS)).select(
        "level", "case_id", "event_pos", "activity_name", iso_utc(F.col("ts")).alias("timestamp_utc"), *more
    )


# Characters that XML cannot hold, and those written as entities.
_NO_XML = r"\x00-\x08\x0B\x0C\x0E-\x1F\uFFFE\uFFFF"
_TO_ESCAPE = rf"[{_NO_XML}{''.join(XML_ENTITIES)}]"


def _escaped(text: Column) -> Column:
    """Text as an XML attribute value; characters that XML cannot hold go."""
    text = F.coalesce(text, F.lit(""))
    found = F.regexp_replace(text, f"[{_NO_XML}]", "")
    for plain, entity in XML_ENTITIES.items():
        found = F.replace(found, F.lit(plain), F.lit(entity))
    return F.when(F.regexp_like(text, F.lit(_TO_ESCAPE)), found).otherwise(text)


def _attribute(kind: str, key: str, value: Column) -> Column:
    return F.concat(F.lit(f'<{kind} key="{key}" value="'), _escaped(value), F.lit('"/>'))


def _with_ends(events: DataFrame) -> DataFrame:
    """Add is_first and is_last of each trace; the flags of ``exported_events`` are taken as they are."""
    if "is_last" in events.columns:
        return events.withColumn("is_first", F.col("event_pos") == 1)
    trace = Window.partitionBy("level", "case_id").orderBy("event_pos")
    return events.withColumns({
        "is_first": F.lag(F.lit(1)).over(trace).isNull(), "is_last": F.lead(F.lit(1)).over(trace).isNull()})


def write_xes(events: DataFrame, path: str, files_per_level: int | None = None) -> None:
    """Write the events as XES, one folder per level, one trace per case of any size.

    A case belongs to one file, by a hash of its id. Each event becomes the lines that
    it needs, with the start of its trace before the first and the end behind the last;
    head and foot of a file are rows of their own. Rows are sorted by file, case and
    position, so no row and no window holds a case. Files are well-formed logs of their
    own; one that no case belongs to is empty.
    """
    spark = events.sparkSession
    files = files_per_level or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = trace_events(_with_ends(events), "is_first", "is_last")
    event = F.concat(
        F.lit("    <event>"), _attribute("string", NAME_KEY, F.col("activity_name")),
        _attribute("date", TIME_KEY, F.col("timestamp_utc")), F.lit("</event>"),
    )
    start = F.concat(F.lit("  <trace>\n    "), _attribute("string", NAME_KEY, F.col("case_id")))
    lines = rows.select(
        "level", F.pmod(F.xxhash64("case_id"), F.lit(files)).alias("file"), F.lit(1).alias("part"), "case_id", "event_pos",
        F.concat_ws("\n", F.when(F.col("is_first"), start), event, F.when(F.col("is_last"), "  </trace>")).alias("value"),
    )
    head = '<?xml version="1.0" encoding="UTF-8"?>\n' + f'<log xmlns="{NAMESPACE}">'
    every = F.explode(F.array(*[F.lit(level) for level in EXPORT_LEVELS])).alias("level")
    ends_of_files = spark.range(files).select(every, F.col("id").alias("file")).select(
        "level", "file", F.inline(F.array(*[
            F.struct(F.lit(part).alias("part"), F.lit(None).cast("string").alias("case_id"),
                     F.lit(None).cast("bigint").alias("event_pos"), F.lit(text).alias("value"))
            for part, text in ((0, head), (2, "</log>"))
        ])))
    sorted_lines = lines.unionByName(ends_of_files).repartition("level", "file").sortWithinPartitions(
        "level", "file", "part", "case_id", "event_pos")
    # The text writer knows no other suffix; readers go by the content.
    sorted_lines.drop("part", "case_id", "event_pos").write.mode("overwrite").partitionBy("level", "file").text(path)


def checked_utc(events: DataFrame, column: str = "timestamp_utc") -> DataFrame:
    """Fail the job at the first text that is no strict UTC time."""
    require_columns(events, "case_id", "activity_name", column)
    message = F.concat(
        F.lit("not a strict UTC time: "), F.coalesce(F.col(column), F.lit("null")),
        F.lit(" in case "), F.coalesce(F.col("case_id"), F.lit("null")),
    )
    checked = F.when(is_strict_utc(F.col(column)), F.col(column)).otherwise(
        F.raise_error(message)
    )
    return events.withColumn(column, checked)
