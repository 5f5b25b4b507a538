"""Counts of many values from one read.

Distinct counts over several columns make Spark expand every row once per column and
once more for the plain counts, and totals need a second read. Here rows are melted
once to (kind, key, value), rows of one value meet in the tasks before the shuffle,
and the distinct counts per key and the totals follow from the counted values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import CREATE

# The kind that counts a value over all rows.
ALL = "all"
# Times of a value that can be kept beside its rows: the first, the last, the first creation.
TIMES = ("first", "last", "created")

Kinds = Mapping[str, tuple[str | None, str]]


def _cells(kind: str, key: str | None, value: str) -> list[Column]:
    return [
        F.lit(kind).alias("kind"),
        (F.lit(None) if key is None else F.col(key)).cast("string").alias("key"),
        F.col(value).cast("string").alias("value"),
    ]


def _counted(
    events: DataFrame, parts: list[Column], names: Sequence[str], times: Sequence[str], create: str,
    beside: Sequence[Column] = (),
) -> DataFrame:
    created = F.when(F.col("operation").eqNullSafe(F.lit(create)), F.col("ts"))
    sources = {"first": (F.col("ts"), F.min), "last": (F.col("ts"), F.max), "created": (created, F.min)}
    melted = events.select(*beside, *[sources[t][0].alias(t) for t in times], F.inline(F.array(*parts)))
    return melted.groupBy(*names).agg(F.count("*").alias("rows"), *[sources[t][1](t).alias(t) for t in times])


def value_facts(events: DataFrame, kinds: Kinds, times: Sequence[str] = (), create: str = CREATE) -> DataFrame:
    """(kind, key, value, rows and times): how many rows have a value beside a key.

    kinds: name to (key column or None for one group of all rows, value column).
    """
    keys = {key for key, _ in kinds.values()}
    shared = next(iter(keys)) if len(keys) == 1 else None
    parts = []
    for kind, columns in kinds.items():
        name, key, value = _cells(kind, *columns)
        # A key that all kinds share stays a column, so that rows laid out by it need no shuffle.
        parts.append(F.struct(name, value) if shared else F.struct(name, key, value))
    beside = [F.col(shared).cast("string").alias("key")] if shared else []
    return _counted(events, parts, ["kind", "key", "value"], times, create, beside)


def subject_facts(
    events: DataFrame, subjects: Mapping[str, Kinds], times: Sequence[str] = TIMES, create: str = CREATE
) -> DataFrame:
    """The facts of several subjects from one read, with the subject in front."""
    parts = [
        F.struct(F.lit(subject).alias("subject"), *_cells(kind, *columns))
        for subject, kinds in subjects.items() for kind, columns in kinds.items()
    ]
    return _counted(events, parts, ["subject", "kind", "key", "value"], times, create)


def counts_of(facts: DataFrame, kind: str, key: str, value: str, *, nulls: bool = False) -> DataFrame:
    """Rows per key and value of a kind, under the names of their columns."""
    found = facts.where(F.col("kind") == kind)
    if not nulls:
        found = found.where(F.col("value").isNotNull())
    return found.select(F.col("key").alias(key), F.col("value").alias(value), F.col("rows").alias("count"))


def rows_of(kind: str, condition: Column | None = None) -> Column:
    """Rows of a kind, over its facts; null without any. condition: on the value."""
    wanted = F.col("kind") == kind
    return F.sum(F.when(wanted if condition is None else wanted & condition, F.col("rows")))


def distinct_of(kind: str, condition: Column | None = None) -> Column:
    """Distinct values of a kind, nulls apart, over its facts."""
    wanted = (F.col("kind") == kind) & F.col("value").isNotNull()
    return F.count_if(wanted if condition is None else wanted & condition)


def count_of(kind: str, condition: Column) -> Column:
    """Rows of a kind whose value meets the condition, over its facts."""
    return F.coalesce(rows_of(kind, condition), F.lit(0).cast("bigint"))


def with_totals(report: DataFrame, facts: DataFrame) -> DataFrame:
    """Add _all: rows and distinct values over all events, from the same facts.

    The totals are a scalar subquery over the shuffled facts, which Spark reuses if both
    need the same columns; so the subquery looks at the times too.
    """
    times = [F.count(c).alias(c) for c in facts.columns if c in TIMES]
    both = F.struct(F.coalesce(rows_of(ALL), F.lit(0)).alias("rows"), distinct_of(ALL).alias("cases"), *times)
    return report.withColumn("_all", facts.agg(both).scalar())
