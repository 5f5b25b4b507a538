"""Product codes of vectors: four codebooks, Lloyd rounds in whole numbers, Orchard search.

A component x counts as floor(1024 x), a vector is cut into equal consecutive parts,
and each part is coded by the nearest entry of its own codebook. Entries start as the
parts of the vectors with the smallest ids; each round assigns all parts and replaces
an entry by the floored mean of its parts, unused entries stay.

The nearest entry is found by Orchard's search: each entry keeps the list of all
entries by distance. A part starts at some entry, walks its list, marks what it
visits, jumps to the list of any better entry, and stops where the list is further
away than twice the current distance: by the triangle inequality nothing beyond can
be as near. Rows of a batch walk side by side, LIST_STEP places of a list at a time.
All is done in whole numbers, so the result does not depend on the start, the
batches or the partitions.

Codebooks are broadcast; their size is fixed by ENTRIES and the length of a vector.
A round returns one row per entry and task, summed in Spark.

Defined results: vectors that are null, empty, or hold null or non-finite components
are dropped, as are those too large for their squared distances to fit a long, and
those of another length than the vector with the smallest id (a length that four
divides). Rows with a null id are coded but start no entry. Rows that share an id
are coded one by one; ties for an entry go by id, then by the vector. With fewer
vectors than ENTRIES there are fewer entries. A label's error is null where a long
cannot hold it. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LIST_STEP, ROWS_AT_ONCE = 8, 1024


class Book:
    """Entries of one part position with their neighbour lists."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        gaps = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        # Each entry heads its own list, before equal ones.
        gaps[np.arange(len(entries)), np.arange(len(entries))] = -1
        self.order = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.maximum(np.take_along_axis(gaps, self.order, axis=1), 0)
        # A start: the entry whose sum of components is next to the part's.
        sums = entries.sum(axis=1)
        self.by_sum = np.argsort(sums, kind="stable")
        self.sums = sums[self.by_sum]

    def distances(self, rows: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Squared distances of rows (n, d) to entries (n,) or (n, k)."""
        if entry.ndim == 1:
            return ((rows - self.entries[entry]) ** 2).sum(axis=1)
        return ((rows[:, None, :] - self.entries[entry]) ** 2).sum(axis=2)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row; ties go to the lower entry."""
        entry = np.empty(len(rows), dtype=np.int64)
        found = np.empty(len(rows), dtype=np.int64)
        for start in range(0, len(rows), ROWS_AT_ONCE):
            part = slice(start, start + ROWS_AT_ONCE)
            entry[part], found[part] = self._walk(rows[part])
        return entry, found

    def _walk(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = len(self.entries)
        at = self.by_sum[np.minimum(np.searchsorted(self.sums, rows.sum(axis=1)), count - 1)]
        best = self.distances(rows, at)
        visited = np.zeros((len(rows), count), dtype=bool)
        visited[np.arange(len(rows)), at] = True
        place = np.ones(len(rows), dtype=np.int64)
        walking = np.arange(len(rows)) if count > 1 else np.empty(0, dtype=np.int64)
        while len(walking):
            own, here = at[walking], place[walking]
            steps = np.minimum(here[:, None] + np.arange(LIST_STEP), count - 1)
            listed, gaps = self.order[own[:, None], steps], self.gaps[own[:, None], steps]
            # Entries that may be as near: not further from the current one than twice its distance.
            wanted = (gaps <= 4 * best[walking][:, None]) & ~visited[walking[:, None], listed]
            wanted &= here[:, None] + np.arange(LIST_STEP) < count
            row, step = np.nonzero(wanted)
            new = listed[row, step]
            visited[walking[row], new] = True
            far = np.full(wanted.shape, np.iinfo(np.int64).max)
            far[row, step] = self.distances(rows[walking[row]], new)
            # The best of the step; of equal ones the lowest entry.
            low = far.min(axis=1)
            which = np.where(far == low[:, None], listed, count).min(axis=1)
            better = (low < best[walking]) | ((low == best[walking]) & (which < own))
            place[walking] = np.where(better, 1, here + LIST_STEP)
            at[walking] = np.where(better, which, own)
            best[walking] = np.where(better, low, best[walking])
            ended = ~better & ((gaps[:, -1] > 4 * best[walking]) | (here + LIST_STEP >= count))
            walking = walking[~ended]
        return at, best


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """(rows, length) of floor(SCALE x)."""
    return np.floor(vectors.astype(np.float64) * SCALE).astype(np.int64)


def parts_of(rows: np.ndarray) -> list[np.ndarray]:
    width = rows.shape[1] // PARTS
    return [rows[:, p * width : (p + 1) * width] for p in range(PARTS)]


def usable(vector: Column) -> Column:
    """Whether a vector can be coded, apart from its length."""
    size = F.size(vector)
    # The squared distance of two vectors stays below 2^62.
    most = F.sqrt(F.lit(float(2**62)) / size) / (2 * SCALE) - 1
    good = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) <= most, F.lit(False)))
    return F.coalesce((size > 0) & good, F.lit(False))


def trained(kept: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after the rounds. kept: node, v, all of one length."""
    spark = kept.sparkSession
    first = kept.where("node is not null").orderBy("node", "v").select("v").limit(entries).collect()
    if not first:
        return []
    books = parts_of(whole_numbers(np.array([r["v"] for r in first], dtype=np.float64)))
    width = books[0].shape[1]
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(books)

        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            search = [Book(b) for b in held.value]
            total = [np.zeros_like(b) for b in held.value]
            count = [np.zeros(len(b), dtype=np.int64) for b in held.value]
            for batch in batches:
                if not len(batch):
                    continue
                for p, part in enumerate(parts_of(whole_numbers(np.stack(batch["v"])))):
                    entry = search[p].nearest(part)[0]
                    np.add.at(total[p], entry, part)
                    np.add.at(count[p], entry, 1)
            for p in range(PARTS):
                used = np.flatnonzero(count[p])
                if not len(used):
                    continue
                yield pd.DataFrame({
                    "part": np.full(len(used), p), "entry": used, "rows": count[p][used], "sums": list(total[p][used])})

        partial = kept.select("v").mapInPandas(sums, "part int, entry int, rows bigint, sums array<bigint>")
        means = partial.groupBy("part", "entry").agg(
            F.sum("rows").alias("rows"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
        books = [b.copy() for b in books]
        # One row per entry that is used: bounded by the codebooks.
        for row in means.collect():
            books[row["part"]][row["entry"]] = [row[f"s{i}"] // row["rows"] for i in range(width)]
        held.unpersist()
    return books


def digest(books: list[np.ndarray]) -> str:
    """Of all components by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def coded(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """id, code, error, label_error, codebooks_sha256 of each row that is kept. entries: 256 at most."""
    rows = table.select(
        F.col(id_col).alias("node"), F.col(vector_col).alias("v"), F.col(label_col).alias("label"))
    rows = rows.where(usable(F.col("v")) & (F.size("v") % PARTS == 0))
    length = rows.select(F.size("v").alias("length"), "node", "v").orderBy(
        F.col("node").asc_nulls_last(), "v").limit(1).collect()
    kept = rows.where(F.size("v") == (length[0]["length"] if length else 0))
    books = trained(kept, entries, rounds)
    if length and not books:  # no row has an id
        first = kept.orderBy("v").limit(entries).withColumn("node", F.monotonically_increasing_id())
        books = trained(first, entries, 0)
    held = table.sparkSession.sparkContext.broadcast(books)

    @F.pandas_udf("code string, error bigint")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        search = [Book(b) for b in held.value]
        for batch in batches:
            codes, error = np.empty((len(batch), PARTS), dtype=np.uint8), np.zeros(len(batch), dtype=np.int64)
            if len(batch):
                for p, part in enumerate(parts_of(whole_numbers(np.stack(batch)))):
                    codes[:, p], far = search[p].nearest(part)
                    error += far
            yield pd.DataFrame({"code": [bytes(c).hex() for c in codes], "error": error})

    found = kept.select("node", "label", encode("v").alias("found")).select("node", "label", "found.*")
    found = staged(found, "vector-codes")
    totals = found.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return found.join(totals, found["label"].eqNullSafe(totals["_label"])).select(
        F.col("node").alias(id_col), "code", "error", "label_error",
        F.lit(digest(books)).alias("codebooks_sha256"))


def codes_sql(table: str = "embeddings", entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB SQL of ``coded`` over a table of vec_id, embedding and label, all vectors of one length."""
    steps = [f"""
        kept AS (SELECT vec_id, label, list_transform(embedding, lambda x : floor({SCALE} * CAST(x AS DOUBLE))) AS v
            FROM {table} WHERE len(embedding) > 0
            AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0),
        parts AS (SELECT vec_id, label, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS x
            FROM kept CROSS JOIN (SELECT unnest(range({PARTS})) AS p)),
        book0 AS (SELECT * FROM (
            SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x AS e FROM parts) WHERE k < {entries})"""]
    for r in range(rounds + 1):
        # Whole numbers in doubles: exact below 2^53.
        steps.append(f"""
        near{r} AS (SELECT vec_id, any_value(label) AS label, p, any_value(x) AS x, min({{'d': d, 'k': k}}) AS best FROM (
            SELECT vec_id, label, p, x, k,
                list_dot_product(x, x) - 2 * list_dot_product(x, e) + list_dot_product(e, e) AS d
            FROM parts JOIN book{r} USING (p)) GROUP BY vec_id, p)""")
        if r < rounds:
            steps.append(f"""
        mean{r} AS (SELECT p, k, list(m ORDER BY i) AS e FROM (
            SELECT p, best.k AS k, i, floor(sum(x[i]) / count(*)) AS m
            FROM near{r}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS i)
            GROUP BY p, best.k, i) GROUP BY p, k),
        book{r + 1} AS (SELECT p, k, coalesce(mean{r}.e, book{r}.e) AS e FROM book{r} LEFT JOIN mean{r} USING (p, k))""")
    steps.append(f"""
        digest AS (SELECT sha256(string_agg(CAST(CAST(e[i] AS BIGINT) AS VARCHAR), ',' ORDER BY p, k, i)) AS codebooks_sha256
            FROM book{rounds}, (SELECT unnest(range(1, (SELECT max(len(e)) FROM book0) + 1)) AS i)),
        codes AS (SELECT vec_id, any_value(label) AS label, string_agg(format('{{:02x}}', best.k), '' ORDER BY p) AS code,
            CAST(sum(best.d) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id)""")
    return f"""WITH {",".join(steps)}
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM codes CROSS JOIN digest"""
