"""Value counts and the most frequent values per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def value_counts(
    rows: DataFrame, columns: Sequence[str], name: str = "count", *, nulls: bool = True
) -> DataFrame:
    """Rows per combination of values; optionally without nulls in the last column."""
    if not nulls:
        rows = rows.where(F.col(columns[-1]).isNotNull())
    return rows.groupBy(*columns).agg(F.count("*").alias(name))


def top_per_group(
    counts: DataFrame, groups: Sequence[str], value: Sequence[str], k: int, name: str = "count"
) -> DataFrame:
    """The k largest counts per group, ties by value; adds the rank.

    Spark keeps k rows per group and task before it shuffles.
    """
    order = Window.partitionBy(*groups).orderBy(F.desc(name), *value)
    ranked = counts.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("bigint"))
