"""Shards of near-equal bytes by histogram sort. DataFrame functions only.

Rows are ordered by (hash of the text, hash of the id, row number). Splitters
come from repeated histograms: each round counts the exact bytes below a grid of
probe keys inside the open interval of each splitter, in one aggregation, and
narrows the interval until a probe meets the tolerance. Equal texts are
neighbours in that order, so a group of copies stays in one shard unless only a
cut inside the group meets the tolerance. The rows move once, after the
splitters are known.

Defined results: a null text has no bytes and counts its overhead only; an empty
table gives no rows; repeated rows are placed one by one; a single row larger
than a shard stays whole. Law ``bytes``: the sizes of the shards are near equal.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

OVERHEAD = 8
# Probes per open interval and round; a round returns at most shards x PROBES counts.
PROBES = 1024
KEYS = ("_k0", "_k1", "_k2")
TOP = (1 << 63) - 1

Splitter = tuple[int, ...]


def _before(splitter: Splitter) -> Column:
    """Whether a row's key lies before the splitter."""
    deeper = F.lit(False)
    for level in reversed(range(len(splitter))):
        key = F.col(KEYS[level])
        deeper = (key < splitter[level]) | ((key == splitter[level]) & deeper)
    return deeper


def _within(fixed: Splitter, low: int, high: int) -> Column:
    """Whether a row's key begins with ``fixed`` and its next part is in the interval."""
    part = F.col(KEYS[len(fixed)])
    found = (part >= low) & (part <= high)
    for level, value in enumerate(fixed):
        found = found & (F.col(KEYS[level]) == value)
    return found


def splitters(rows: DataFrame, shards: int, tolerance: float) -> list[Splitter]:
    """shards - 1 keys; the bytes below the i-th are near i / shards of all."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / shards
    targets = [total * i / shards for i in range(1, shards)]
    # Per splitter: the fixed key parts, the open interval of the next part, the bytes below.
    open_ = {i: ((), 0, TOP, 0) for i in range(len(targets))}
    found: dict[int, Splitter] = {}
    while open_ and total:
        places = sorted(set(open_.values()))
        step = {p: -(-(p[2] - p[1] + 1) // PROBES) for p in places}
        cell = F.lit(None).cast("struct<place:int,bin:bigint>")
        for number, p in enumerate(places):
            bin_ = F.expr(f"({KEYS[len(p[0])]} - {p[1]}L) div {step[p]}L")
            inside = F.struct(F.lit(number).alias("place"), bin_.alias("bin"))
            cell = F.when(_within(*p[:3]), inside).otherwise(cell)
        counts = rows.select(cell.alias("cell"), "size").where(F.col("cell").isNotNull())
        grid: dict[int, list[int]] = {n: [0] * PROBES for n in range(len(places))}
        for place, bin_, size in counts.groupBy("cell.place", "cell.bin").agg(F.sum("size")).collect():
            grid[place][bin_] = size
        for i, p in list(open_.items()):
            fixed, low, high, below = p
            sums = list(accumulate(grid[places.index(p)], initial=below))
            at = min(bisect_right(sums, targets[i]) - 1, PROBES - 1)
            near = min((at, at + 1), key=lambda n: abs(sums[n] - targets[i]))
            edge = low + near * step[p]
            narrow = (low + at * step[p], min(high, low + (at + 1) * step[p] - 1))
            last = narrow[0] >= narrow[1] and len(fixed) == len(KEYS) - 1
            if abs(sums[near] - targets[i]) <= slack or last:
                found[i] = (*fixed, min(edge, TOP))
                del open_[i]
            elif narrow[0] >= narrow[1]:
                open_[i] = ((*fixed, narrow[0]), 0, TOP, sums[at])
            else:
                open_[i] = (fixed, *narrow, sums[at])
    return sorted(found.values())


def sharded(
    docs: DataFrame,
    shards: int = 24,
    tolerance: float = 0.01,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc id, size, text_crc32, law, shard, slot, grown_shard (null under this law).

    Slots count from 0 without gaps in each shard. They are numbered per (shard,
    input partition) and shifted by the rows of the partitions before, so that no
    task holds a shard.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(
        docs.select(
            F.col(id_col),
            (F.octet_length(text).cast("bigint") + OVERHEAD).alias("size"),
            F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64(text), 1).alias("_k0"),
            F.shiftrightunsigned(F.xxhash64(F.col(id_col)), 1).alias("_k1"),
            F.monotonically_increasing_id().alias("_k2"),
        ),
        "sizes",
    )
    shard = F.lit(shards - 1)
    for number, splitter in reversed(list(enumerate(splitters(rows, shards, tolerance)))):
        shard = F.when(_before(splitter), F.lit(number)).otherwise(shard)
    placed = rows.withColumn("shard", shard.cast("int"))
    placed = placed.withColumn("_part", F.shiftright("_k2", 33))
    own = Window.partitionBy("shard", "_part").orderBy("_k2")
    sizes = placed.groupBy("shard", "_part").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    numbered = placed.withColumn("_row", F.row_number().over(own)).join(starts, ["shard", "_part"])
    return numbered.select(
        F.col(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_start") + F.col("_row") - 1).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
