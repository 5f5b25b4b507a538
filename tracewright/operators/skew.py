"""Windows over groups of any size.

A window sends each group to one task. That is right for ordinary cases and
wrong for one that holds a large share of all rows. The helpers here give the
groups above a row limit another, exact way, in one plan that is the same for all
sizes and runs nothing while it is built:

* ``by_group_size`` runs the window form on ordinary groups and a form of your
  choice (aggregation, group limit, slices) on the large ones. Which groups are
  large is an aggregation inside the plan; its few keys are broadcast, and if there
  are none Spark drops the second branch before it reads anything.
* ``with_previous`` and ``with_position`` cut large groups into slices of time,
  run the window per slice and carry the boundary from slice to slice.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows above which a group no longer goes to one task.
LARGE_GROUP_ROWS = 5_000_000


def large_groups(rows: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """The keys with more than ``limit`` rows.

    One aggregation with map-side partial counts. There are fewer than
    (all rows / limit) such keys, which bounds what is broadcast.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_rows"))
    return counts.where(F.col("_rows") > limit).select(*keys)


def split_by_size(
    rows: DataFrame, keys: Sequence[str], large: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary and of large groups. Null keys form a group of their own."""
    table = F.broadcast(large.select(*[F.col(k).alias(f"_large_{k}") for k in keys]))
    same = None
    for k in keys:
        match = rows[k].eqNullSafe(table[f"_large_{k}"])
        same = match if same is None else same & match
    return rows.join(table, same, "left_anti"), rows.join(table, same, "left_semi")


def by_group_size(
    rows: DataFrame,
    keys: Sequence[str],
    build: Callable[[DataFrame, bool], DataFrame],
    limit: int = LARGE_GROUP_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``build(rows, False)`` on ordinary groups, ``build(rows, True)`` on large ones.

    counted: what to count instead of ``rows``, for callers with a cheaper frame
    whose groups are at least as large. Pass rows that are cheap to read again and do
    the costly steps in ``build``: the rows of each branch go through them once.
    """
    large = large_groups(rows if counted is None else counted, keys, limit)
    ordinary, rest = split_by_size(rows, keys, large)
    return build(ordinary, False).unionByName(build(rest, True))


def first_per_key(
    rows: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]
) -> DataFrame:
    """The first row per key. Spark keeps one row per key and task before it shuffles."""
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = rows.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir, deleted when the application ends.

    A temporary folder is used only with a local master.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="durable-")
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def durable(rows: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them from there.

    The rows never change again, also if executors are lost.
    """
    path = shared_path(rows.sparkSession, "rows")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _with_slice(rows: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Add _slice, which follows the order: the hour of the first key, or the key itself.

    The number of slices of a group follows the time span of the log and not its rows.
    """
    first = rows.select(order[0] if isinstance(order[0], Column) else F.col(order[0])).schema[0]
    key = order[0] if isinstance(order[0], Column) else F.col(order[0])
    hours = isinstance(first.dataType, (T.TimestampType, T.TimestampNTZType))
    return rows.withColumn("_slice", F.date_trunc("hour", key) if hours else key)


def _joined_to_slices(rows: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on (keys, slice), null-safe; both sides are spread by slice."""
    names = [*keys, "_slice"]
    table = carry.withColumnsRenamed({k: f"_carry_{k}" for k in names})
    match = None
    for k in names:
        same = rows[k].eqNullSafe(table[f"_carry_{k}"])
        match = same if match is None else match & same
    return rows.join(table, match, "left").drop(*[f"_carry_{k}" for k in names])


def with_previous(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    name: str = "previous",
    limit: int = LARGE_GROUP_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add a struct of the previous row's columns; null on the first row of a group."""
    value = F.struct(*columns)

    def build(part: DataFrame, large: bool) -> DataFrame:
        if not large:
            window = Window.partitionBy(*keys).orderBy(*order)
            return part.withColumn(name, F.lag(value).over(window))
        part = _with_slice(part, order)
        window = Window.partitionBy(*keys, "_slice").orderBy(*order)
        inside = part.withColumn(name, F.lag(value).over(window))
        last = first_per_key(part, [*keys, "_slice"], [F.desc(c) for c in order])
        by_slice = Window.partitionBy(*keys).orderBy("_slice")
        carry = last.select(*keys, "_slice", F.lag(value).over(by_slice).alias("_carried"))
        return (
            _joined_to_slices(inside, carry, keys)
            .withColumn(name, F.coalesce(name, "_carried"))
            .drop("_slice", "_carried")
        )

    return by_group_size(rows, keys, build, limit, counted)


def positions(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str, *, large: bool, last: str = "_last"
) -> DataFrame:
    """Add the 1-based position in the group, by window or, for large groups, by slices.

    last: the name of a flag for the last row of a group; left out by default.
    """
    shown = [name] if last == "_last" else [name, last]
    kept = [*rows.columns, *shown]
    if not large:
        window = Window.partitionBy(*keys).orderBy(*order)
        place = F.row_number().over(window).cast("bigint")
        return rows.withColumns({name: place, last: F.lead(F.lit(1)).over(window).isNull()}).select(*kept)
    rows = _with_slice(rows, order)
    window = Window.partitionBy(*keys, "_slice").orderBy(*order)
    inside = rows.withColumn("_inside", F.row_number().over(window))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = rows.groupBy(*keys, "_slice").agg(F.count("*").alias("_size"))
    total = F.sum("_size").over(Window.partitionBy(*keys))
    offsets = sizes.select(*keys, "_slice", F.sum("_size").over(before).alias("_offset"), total.alias("_total"))
    placed = _joined_to_slices(inside, offsets, keys).withColumn(name, F.col("_inside") + F.coalesce("_offset", F.lit(0)))
    return placed.withColumn(last, F.col(name) == F.col("_total")).select(*kept)


def with_position(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    name: str,
    limit: int = LARGE_GROUP_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add the 1-based position of each row in its group."""

    def build(part: DataFrame, large: bool) -> DataFrame:
        return positions(part, keys, order, name, large=large)

    return by_group_size(rows, keys, build, limit, counted)
