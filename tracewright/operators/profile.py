"""Column profiles: completeness, distinct values and frequent values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import percent
from ..functions.text import clipped
from ..functions.timestamps import DAY_FIRST_FORMATS, local_parser, parsed
from .topk import top_per_group


def _column(name: str) -> Column:
    """A column by its literal name, which may hold dots and back ticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def column_values(table: DataFrame) -> DataFrame:
    """Rows per column and value, as (column, value, count).

    One pass over all columns. Rows of one value meet before the shuffle, so the
    row multiplication by ``unpivot`` stays inside the tasks.
    """
    names = table.columns
    texts = table.select(*[_column(name).cast("string").alias(name) for name in names])
    cells = texts.unpivot([], [_column(name) for name in names], "column", "value")
    return cells.groupBy("column", "value").agg(F.count("*").alias("count"))


def _numbers(table: DataFrame) -> list[str]:
    return [f.name for f in table.schema.fields if isinstance(f.dataType, T.NumericType)]


def _per_column(table: DataFrame, names: Sequence[str], measures: dict) -> DataFrame:
    """One row per column with several measures, from a single aggregation."""
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            *[measure(_column(name)).alias(label) for label, measure in measures.items()],
        )
        for name in names
    ]
    return table.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def column_profile(table: DataFrame) -> DataFrame:
    """Type, rows, nulls, blanks, distinct values and, for numbers, the range."""
    count, value = F.col("count"), F.col("value")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, count).otherwise(0))

    kinds = F.create_map(*[F.lit(x) for pair in table.dtypes for x in pair])
    profile = column_values(table).groupBy("column").agg(
        F.sum("count").alias("total_rows"),
        total(value.isNull()).alias("null_count"),
        total(F.coalesce(value == "", F.lit(False))).alias("empty_string_count"),
        total(value.isNotNull()).alias("non_null_count"),
        F.count("value").alias("unique_values"),
    )
    profile = profile.withColumn("dtype", F.element_at(kinds, F.col("column")))
    measures = {
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
        "mean": lambda c: F.avg(c),
    }
    numbers = _numbers(table)
    if not numbers:
        return profile.withColumns({m: F.lit(None).cast("double") for m in measures})
    ranges = _per_column(table, numbers, measures)
    return profile.join(ranges, "column", "left")


def date_profile(
    table: DataFrame, column: str, formats: Sequence[str] = DAY_FIRST_FORMATS
) -> DataFrame:
    """First and last time of a text column and how many values cannot be read."""
    known = table.where(F.col(column).isNotNull())
    times = known.select(parsed(F.col(column), local_parser(formats)).alias("ts"))
    return times.agg(
        F.lit(column).alias("column"),
        F.min("ts").alias("min_timestamp"),
        F.max("ts").alias("max_timestamp"),
        F.count_if(F.col("ts").isNull()).alias("parse_failure_count"),
    )


def value_frequencies(table: DataFrame, k: int = 20, chars: int | None = None) -> DataFrame:
    """The most frequent values per column, cut to chars, with their share of all rows."""
    counts = column_values(table)
    top = top_per_group(counts.where("value is not null"), ["column"], ["value"], k)
    rows = table.agg(F.count("*")).scalar()
    return top.withColumn("_rows", rows).select(
        "column",
        clipped(F.col("value"), chars).alias("value"),
        F.col("count").alias("frequency"),
        percent(F.col("count"), F.col("_rows")).alias("percentage"),
        "rank",
    )
