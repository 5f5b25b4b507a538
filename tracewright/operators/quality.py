"""How well the raw timestamps could be read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timestamps import shape_label
from .actors import whole_days


def timestamp_summary(timed: DataFrame) -> DataFrame:
    """Rows read and dropped, first and last time, full days between them.

    ``timed`` holds all rows, with a null ts where the text could not be read.
    """
    totals = timed.agg(
        F.count("ts").alias("rows_after_parse"),
        F.count_if(F.col("ts").isNull()).alias("rows_dropped_invalid"),
        F.min("ts").alias("min_timestamp"),
        F.max("ts").alias("max_timestamp"),
    )
    days = F.coalesce(whole_days("min_timestamp", "max_timestamp"), F.lit(0).cast("bigint"))
    return totals.withColumn("timespan_days", days)


def shape_counts(events: DataFrame, raw: str) -> DataFrame:
    """Rows per shape of the raw text, over the rows that could be read."""
    return events.groupBy(shape_label(F.col(raw)).alias("shape")).agg(
        F.count("*").alias("count")
    )
