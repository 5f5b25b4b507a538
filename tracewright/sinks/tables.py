"""Event-log tables, removed cases and reports as files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timestamps import iso_utc


def with_utc_text(events: DataFrame) -> DataFrame:
    """Replace ts by timestamp_utc, the text form used in files."""
    return events.withColumn("timestamp_utc", iso_utc(F.col("ts"))).drop("ts")


def write_event_log(log: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Write the cleaned log, all columns and levels, as Parquet or CSV.

    CSV is sorted by case and place in the case, over all files. Parquet is
    partitioned by level, so that readers of one level skip the rest.
    """
    if file_format == "csv":
        with_utc_text(log).orderBy("case_id", "event_pos").write.mode("overwrite").option("header", True).csv(path)
    elif file_format == "parquet":
        log.write.mode("overwrite").partitionBy("level").parquet(path)
    else:
        raise ValueError("file_format must be 'parquet' or 'csv'")


def write_case_table(log: DataFrame, table: str, path: str | None = None, buckets: int | None = None) -> DataFrame:
    """Write the log as a Parquet table bucketed and sorted by case, and return it.

    Jobs by case over the table need no shuffle of the events. The log is already
    partitioned by case, so with as many buckets as shuffle partitions (the default)
    a task writes one file for each bucket it holds.
    path: where the files go, by default the warehouse.
    """
    spark = log.sparkSession
    number = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = log.write.mode("overwrite").format("parquet").bucketBy(number, "case_id").sortBy("case_id", "event_pos")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)
    return spark.table(table)


def write_removed_cases(singles: DataFrame, path: str) -> None:
    """Write the rows of removed single-event cases as CSV."""
    with_utc_text(singles).write.mode("overwrite").option("header", True).csv(path)


def write_case_metrics(cases: DataFrame, path: str) -> None:
    """Write the case table as CSV, largest cases first."""
    ordered = cases.orderBy(F.desc("event_count"), "case_id")
    ordered.write.mode("overwrite").option("header", True).csv(path)


def write_value_frequencies(frequencies: DataFrame, path: str) -> None:
    """Write the frequent values as CSV."""
    ordered = frequencies.orderBy("column", "rank").drop("rank")
    ordered.write.mode("overwrite").option("header", True).csv(path)


def write_reports(reports: Mapping[str, DataFrame], folder: str) -> None:
    """Write each report as JSON lines into a folder of its own."""
    for name, report in reports.items():
        report.write.mode("overwrite").json(f"{folder}/{name}")


def document(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Small reports as one JSON document (column ``value``), an array of rows per part.

    Rows are sorted by their columns from left to right, so that a report is the same
    text on every run. The parts are reports: their size follows the number of fields,
    actors or bands and not that of the events. Reports by case belong into files of
    their own.
    """
    arrays = [
        part.agg(F.sort_array(F.coalesce(F.collect_list(F.struct("*")), F.array())).alias(name)).scalar().alias(name)
        for name, part in parts.items()
    ]
    spark = next(iter(parts.values())).sparkSession
    return spark.range(1).select(F.to_json(F.struct(*arrays)).alias("value"))


def write_documents(documents: Mapping[str, Mapping[str, DataFrame]], folder: str) -> None:
    """Write each document as a text file of its own folder."""
    for name, parts in documents.items():
        document(parts).write.mode("overwrite").text(f"{folder}/{name}")
