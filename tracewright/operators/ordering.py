"""Create aggregation, canonical order and deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import LARGE_GROUP_ROWS, by_group_size, first_per_key, with_position

# The operation that creates an item and the name of its event.
CREATE = "Create"
CASE_CREATED = "Case Created"


# Order of the rows of a case in which the first create row comes first.
CREATE_ORDER = ("is_create", "ts", "ingest_ord")


def with_create_flag(events: DataFrame, create: str = CREATE) -> DataFrame:
    """Add is_create: the operation is exactly the creating one."""
    return events.withColumn("is_create", F.col("operation").eqNullSafe(F.lit(create)))


def collapse_creates(events: DataFrame, *, large: bool = False) -> DataFrame:
    """Reduce the create rows (is_create) of each case to one "Case Created" event.

    The earliest row is kept. If it has a sequence it takes the smallest one
    among the case's create rows. All other rows stay as they are.
    ``large`` avoids windows over whole cases: the first row comes from a group
    limit and the smallest sequence from an aggregation, both of which reduce
    the rows of a case before they are shuffled.
    """
    if not large:
        group = Window.partitionBy("case_id", "is_create")
        first = F.row_number().over(group.orderBy("ts", "ingest_ord"))
        ranked = events.withColumns({"_rank": first, "_least": F.min("sequence").over(group)})
        kept = ranked.where(~F.col("is_create") | (F.col("_rank") == 1))
        return _as_case_created(kept).drop("_rank", "_least")
    creates = events.where("is_create")
    least = creates.groupBy(F.col("case_id").alias("_case")).agg(
        F.min("sequence").alias("_least")
    )
    first = first_per_key(creates, ["case_id"], ["ts", "ingest_ord"])
    first = first.join(least, F.col("case_id") == F.col("_case"), "left")
    created = _as_case_created(first).drop("_case", "_least")
    return created.unionByName(events.where("not is_create"))


def _as_case_created(events: DataFrame) -> DataFrame:
    sequenced = F.col("is_create") & F.col("sequence").isNotNull()
    name = F.when(F.col("is_create"), CASE_CREATED).otherwise(F.col("activity_name"))
    least = F.when(sequenced, F.col("_least")).otherwise(F.col("sequence"))
    return events.withColumns({"sequence": least, "activity_name": name})


def create_aggregated(
    events: DataFrame, limit: int = LARGE_GROUP_ROWS, counted: DataFrame | None = None
) -> DataFrame:
    """``collapse_creates`` for cases of any size."""

    def build(rows: DataFrame, large: bool) -> DataFrame:
        return collapse_creates(rows, large=large)

    return by_group_size(events, ["case_id"], build, limit, counted)


def order_keys() -> dict[str, Column]:
    """The canonical order of events inside a case, as named sort keys.

    Time; then changes of the status code on the stage level; then events with a
    sequence, by sequence; then the collapsed create event; then input order.
    """
    status = (F.col("bucket") == "L1_STAGE") & (F.lower("field") == "statuscode")
    return {
        "ts": F.col("ts"),
        "after_status": F.when(status, 0).otherwise(1),
        "no_sequence": F.col("sequence").isNull().cast("int"),
        "sequence_or_zero": F.coalesce("sequence", F.lit(0).cast("bigint")),
        "after_create": F.when(F.col("is_create"), 0).otherwise(1),
        "ingest_ord": F.col("ingest_ord"),
    }


def in_canonical_order(events: DataFrame) -> DataFrame:
    """Sort the whole log: a range-partitioned sort, so large cases spread out."""
    return events.orderBy("case_id", *order_keys().values())


def with_event_pos(
    events: DataFrame, limit: int = LARGE_GROUP_ROWS, counted: DataFrame | None = None
) -> DataFrame:
    """Add event_pos, the place of an event in its case in canonical order."""
    order = [*order_keys().values()]
    return with_position(events, ["case_id"], order, "event_pos", limit, counted)


def deduplicated(
    events: DataFrame, keys: Sequence[str] = ("case_id", "activity_name", "ts")
) -> DataFrame:
    """Keep the first event per key in canonical order."""
    order = [key for name, key in order_keys().items() if name not in keys]
    return first_per_key(events, keys, order)
