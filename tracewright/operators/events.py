"""Timestamps, case keys and the first filters of the cleaning pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import timestamps as t
from ..functions.text import normalized
from .skew import LARGE_GROUP_ROWS, by_group_size


def with_time(audit: DataFrame, parser: t.Parser, raw: str = "logged_at") -> DataFrame:
    """Add ts to every row; null where the text cannot be read.

    ``utc_parser`` reads two-digit years month-first and ``local_parser`` reads
    them day-first, so the two can turn one text into different days.
    """
    return audit.withColumn("ts", t.parsed(F.col(raw), parser))


def valid_time(audit: DataFrame, parser: t.Parser, raw: str = "logged_at") -> DataFrame:
    """Add ts and keep the rows that have one."""
    return audit.withColumn("ts", F.explode(t.readable(F.col(raw), parser)))


def invalid_time(audit: DataFrame, parser: t.Parser, raw: str = "logged_at") -> DataFrame:
    """The rows without a time, with the reason."""
    timed = with_time(audit, parser, raw)
    reason = t.drop_reason(F.col(raw), F.col("ts"))
    return timed.withColumn("drop_reason", reason).where("drop_reason is not null").drop("ts")


def with_case_ids(events: DataFrame, *, raw: str = "case_key") -> DataFrame:
    """Add case_id, the case key without surplus white space."""
    return events.withColumn("case_id", normalized(F.coalesce(raw, F.lit(""))))


def by_case_key(audit: DataFrame) -> DataFrame:
    """Add case_id, the case key as it is, which is what the analyses group by."""
    return audit.withColumn("case_id", F.col("case_key")).drop("case_key")


def not_strict_utc(events: DataFrame, column: str) -> DataFrame:
    """The rows whose text is no strict UTC time; exports need this to be empty."""
    return events.where(~t.is_strict_utc(F.col(column)))


def case_sized(rows: DataFrame, *, large: bool = False, order: Sequence[str] = ()) -> DataFrame:
    """Add single, whether a row is the only one of its case.

    ``order`` sorts the rows inside a case for the benefit of a following window,
    which then needs no sort of its own.
    ``large`` counts by aggregation. A case may be large by its raw rows and have
    few with a time, so it is counted like any other. There is one row per large
    case, fewer than (all rows / limit), which bounds the broadcast.
    """
    if large:
        sizes = rows.groupBy(F.col("case_id").alias("_case")).agg(F.count("*").alias("_size"))
        sized = rows.join(F.broadcast(sizes), F.col("case_id").eqNullSafe(F.col("_case"))).drop("_case")
    else:
        case = Window.partitionBy("case_id")
        if order:
            case = case.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        sized = rows.withColumn("_size", F.count("*").over(case))
    return sized.withColumn("single", F.col("_size") == 1).drop("_size")


def multi_event(rows: DataFrame, *, large: bool = False, order: Sequence[str] = ()) -> DataFrame:
    """Keep the rows of cases with two rows or more."""
    return case_sized(rows, large=large, order=order).where("not single").drop("single")


def multi_event_rows(
    events: DataFrame, limit: int = LARGE_GROUP_ROWS, counted: DataFrame | None = None
) -> DataFrame:
    """``multi_event`` for cases of any size."""

    def build(rows: DataFrame, large: bool) -> DataFrame:
        return multi_event(rows, large=large)

    return by_group_size(events, ["case_id"], build, limit, counted)


def single_event_rows(events: DataFrame) -> DataFrame:
    """The rows of cases with one row.

    At most two rows of a case and task reach the shuffle, so cases of any size
    will do; of what is left, cases with one row are the single ones.
    """
    case = Window.partitionBy("case_id")
    two = events.withColumn("_row", F.row_number().over(case.orderBy("ingest_ord"))).where("_row <= 2")
    sized = two.withColumn("_size", F.count("*").over(case))
    return sized.where(F.col("_size") == 1).select(events.columns)
