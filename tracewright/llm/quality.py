"""Quality classifier: votes of the nearest labelled documents in a latent-semantic space.

A text becomes counts of terms: its words, the shapes of its words (runs of lower case,
upper case, digits and each other character count once), shapes of neighbouring words,
word lengths, line lengths, and the share of words that repeat one of the four before
them. Terms fall into a table of fixed size, a band of it for each kind. Weights are log counts times the
inverse document frequency over all documents, each kind scaled to length one, so that
the many words do not hide the few shapes.

The latent space is the truncated singular value decomposition of the labelled sample
(randomised, with power steps). Labelled vectors are broadcast; their number is
bounded by ``FIT_EACH`` for each label. Every document is projected and compared with all labelled
vectors in blocks of exact cosine products. The ``NEIGHBOURS`` most similar ones vote with
their similarity to the power ``SHARPNESS``, scaled by label to the shares that the labels
have among all labelled rows, and the score is the share of votes for label 1.

Only the labelled sample is bounded; document frequencies cover all documents and
scoring takes whole texts. The driver holds at most 2 x FIT_EACH rows of at most TERMS
terms. Sample rows are taken by a hash of the id; equal texts count once, with the
label that most of them have (0 if as many).

Defined results: texts without words, null and empty ones, have the share of label 1
among the labelled rows as score (0 without labels), as has every text if all labels
are the same or no labelled text has words. A document labelled twice has the lower
label; null labels and ids are not learnt from. Repeated rows are scored alike. Very
long texts are counted in pieces. An empty table gives no rows. Columns named score
or predicted are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, whole_text

FIT_EACH = 1500
DIMENSIONS, NEIGHBOURS, SHARPNESS, POWER_STEPS = 48, 15, 4, 4
CUT = 0.3
# Bands of the table: words, shapes, pairs of shapes, word lengths, line lengths, share of repeats.
BANDS = (4096, 1024, 2048, 32, 32, 16)
STARTS = np.concatenate([[0], np.cumsum(BANDS)])
TERMS = int(STARTS[-1])
PIECE_WORDS = 1 << 19


def shape(word: str) -> str:
    """Runs of one kind of character as one mark."""
    out = []
    for c in word:
        mark = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "o" if c.isalpha() else c
        if not out or out[-1] != mark:
            out.append(mark)
    return "".join(out)


class Words(dict):
    """Place (12 bits), length (5) and hashed shape (31) of each word, found once; forgets all beyond a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        text = word.decode("utf-8")
        # A word is known by its letters and digits alone; marks around them belong to the shape.
        plain = "".join(c for c in text.lower() if c.isalnum())[:64]
        found = xxhash.xxh3_64_intdigest(plain) % BANDS[0] | min(BANDS[3] - 1, len(text)) << 12
        found |= (xxhash.xxh3_64_intdigest(shape(text)) & 0x7FFFFFFF) << 17
        self[word] = found
        return found


def terms(text: str, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term places of a text and their counts."""
    raw = text.encode("utf-8")
    found = raw.split()
    total = np.zeros(TERMS, dtype=np.int64)
    before, repeats = np.empty(0, dtype=np.int64), 0
    for start in range(0, len(found), PIECE_WORDS):
        piece = found[start : start + PIECE_WORDS]
        known = np.fromiter(map(words.__getitem__, piece), dtype=np.int64, count=len(piece))
        own, lengths, shapes = known & 0xFFF, known >> 12 & 0x1F, known >> 17
        places = [own, shapes % BANDS[1] + STARTS[1], lengths + STARTS[3]]
        places.append((shapes[:-1] * 31 + shapes[1:] * 17) % BANDS[2] + STARTS[2])
        total += np.bincount(np.concatenate(places), minlength=TERMS)
        chain = np.concatenate([before, known])
        same = np.zeros(len(chain), dtype=bool)
        for back in (1, 2, 3, 4):
            same[back:] |= chain[back:] == chain[: len(chain) - back] if len(chain) > back else False
        repeats += int(same[len(before) :].sum())
        before = chain[-4:]
    if len(found):
        lines = np.diff(np.flatnonzero(np.frombuffer(b"\n" + raw + b"\n", dtype=np.uint8) == 10)) - 1
        sizes = np.minimum(BANDS[4] - 1, np.ceil(2 * np.log2(lines + 1)).astype(np.int64))
        total += np.bincount(sizes + STARTS[4], minlength=TERMS)
        total[STARTS[5] + -(-(BANDS[5] - 1) * repeats // len(found))] += 1
    place = np.flatnonzero(total)
    return place, total[place]


def weighted(place: np.ndarray, count: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """Log counts times inverse document frequencies, each band of length one."""
    weight = (1 + np.log(count)) * inverse[place]
    edges = np.searchsorted(place, STARTS)
    for low, high in zip(edges, edges[1:]):
        size = np.sqrt((weight[low:high] ** 2).sum())
        if size > 0:
            weight[low:high] /= size
    return weight


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; rows of zeros stay."""
    size = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, size, out=np.zeros_like(rows), where=size > 1e-12)


def latent(rows: list[tuple[np.ndarray, np.ndarray]], dimensions: int = DIMENSIONS) -> np.ndarray:
    """(TERMS, dimensions): the main right singular vectors of the sparse rows."""
    place = np.concatenate([p for p, _ in rows])
    weight = np.concatenate([w for _, w in rows])
    starts = np.cumsum([0, *[len(p) for p, _ in rows]])
    order = np.argsort(place, kind="stable")
    names = np.repeat(np.arange(len(rows)), np.diff(starts))[order]
    used, first = np.unique(place[order], return_index=True)
    slots = np.append(first, len(place))

    def times(right: np.ndarray) -> np.ndarray:
        return np.stack([weight[a:b] @ right[place[a:b]] for a, b in zip(starts, starts[1:])])

    def transposed(left: np.ndarray) -> np.ndarray:
        out = np.zeros((TERMS, left.shape[1]))
        for term, a, b in zip(used.tolist(), slots, slots[1:]):
            out[term] = weight[order[a:b]] @ left[names[a:b]]
        return out

    width = min(dimensions + 8, len(rows), len(used))
    basis = np.random.default_rng(11).standard_normal((TERMS, width))
    for _ in range(POWER_STEPS):
        left = np.linalg.qr(times(basis))[0]
        basis = transposed(left)
    right, values, _ = np.linalg.svd(basis, full_matrices=False)
    keep = values > 1e-9 * max(values[0], 1e-300)
    return right[:, keep][:, :dimensions]


class Model:
    """Inverse document frequencies, projection, labelled vectors with their votes, the share of label 1."""

    def __init__(self, inverse, projection, vectors, labels, share) -> None:
        self.inverse, self.projection, self.share = inverse, projection, share
        self.vectors, self.labels = vectors, labels
        count = np.bincount(labels, minlength=2)
        # What a vote of each label counts, so that the sample's shares do not matter.
        self.votes = np.array([1 - share, share]) / np.maximum(1, count)
        self.votes /= max(self.votes.max(), 1e-300)

    def project(self, place: np.ndarray, count: np.ndarray) -> np.ndarray:
        return weighted(place, count, self.inverse) @ self.projection[place]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Scores of projected rows."""
        rows = unit(rows)
        out = np.full(len(rows), self.share)
        most = min(NEIGHBOURS, len(self.labels))
        number = np.arange(len(self.labels))
        for start in range(0, len(rows), 256):
            near = rows[start : start + 256] @ self.vectors.T
            # Rounded, ties to the first: the neighbours do not depend on the blocks.
            rank = np.rint(near * (1 << 30)).astype(np.int64) * len(number) - number
            found = np.argpartition(rank, len(number) - most, axis=1)[:, len(number) - most :]
            found.sort(axis=1)
            like = np.maximum(0, np.take_along_axis(near, found, axis=1)) ** SHARPNESS
            vote = like * self.votes[self.labels[found]]
            total = vote.sum(axis=1)
            good = total > 0
            part = out[start : start + 256]
            part[good] = (vote * self.labels[found]).sum(axis=1)[good] / total[good]
        return np.clip(out, 0.0, 1.0)


def _counted(rows: DataFrame, schema: str, *kept: str) -> DataFrame:
    """place and count (arrays) of each row's text beside the kept columns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in batches:
            for start in range(0, len(batch), 200):
                part = batch.iloc[start : start + 200]
                found = [terms(t, words) for t in part["_text"]]
                yield part[list(kept)].assign(place=[p for p, _ in found], count=[c for _, c in found])

    return rows.mapInPandas(run, f"{schema}, place array<bigint>, count array<bigint>")


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[int, np.ndarray]:
    """(documents, how many of them have each term): one row per term and task is shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, seen, rows = Words(), np.zeros(TERMS, dtype=np.int64), 0
        for batch in batches:
            for text in batch["_text"]:
                seen[terms(text, words)[0]] += 1
                rows += 1
        used = np.flatnonzero(seen)
        yield pd.DataFrame({"term": np.append(used, -1), "n": np.append(seen[used], rows)})

    found = docs.select(whole_text(text_col).alias("_text")).mapInPandas(run, "term int, n bigint")
    out, total = np.zeros(TERMS), 0
    # At most TERMS + 1 rows.
    for term, n in found.groupBy("term").agg(F.sum("n")).collect():
        if term < 0:
            total = n
        else:
            out[term] = n
    return total, out


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", each: int = FIT_EACH
) -> Model:
    """The classifier. labels: id and ``quality``, only the rows to learn from; each: documents taken of a label."""
    named = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
    named = named.groupBy(id_col).agg(F.min("quality").cast("int").alias("quality"))
    total, seen = document_frequencies(docs, text_col)
    inverse = np.log((total + 1) / (seen + 1)) + 0.1
    share = named.agg(F.avg("quality")).first()[0] or 0.0
    order = F.xxhash64(F.col(id_col))
    rows = [named.where(F.col("quality") == y).orderBy(order, id_col).limit(each) for y in (0, 1)]
    # At most 2 x each ids: bounded by a constant.
    picked = F.broadcast(rows[0].unionByName(rows[1]))
    sample = docs.select(id_col, whole_text(text_col).alias("_text")).join(picked, id_col)
    texts = staged(sample.groupBy("_text").agg(F.avg("quality").alias("quality")), "quality-sample")
    found = _counted(
        texts.select("_text", (F.col("quality") > 0.5).cast("int").alias("quality"), F.xxhash64("_text").alias("name")),
        "quality int, name bigint", "quality", "name")
    sparse = [
        (np.array(r["place"]), np.array(r["count"]), r["quality"])
        for r in found.where(F.size("place") > 0).orderBy("name", "place", "count").collect()
    ]
    label = np.array([y for _, _, y in sparse], dtype=np.int64)
    if len(set(label.tolist())) < 2:
        return Model(inverse, np.zeros((TERMS, 1)), np.zeros((len(label), 1)), label, float(share))
    projection = latent([(p, weighted(p, c, inverse)) for p, c, _ in sparse])
    model = Model(inverse, projection, np.zeros((0, projection.shape[1])), label, float(share))
    model.vectors = unit(np.stack([model.project(p, c) for p, c, _ in sparse]))
    return model


def scored(docs: DataFrame, model: Model, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """Add score and predicted (1 from ``cut`` on)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, words = held.value, Words()
        for batch in batches:
            rows = np.zeros((len(batch), model.projection.shape[1]))
            for i, text in enumerate(batch):
                place, count = terms(text, words)
                if len(place):
                    rows[i] = model.project(place, count)
            yield pd.Series(model.scores(rows))

    return docs.withColumn("score", score(whole_text(text_col))).withColumn(
        "predicted", (F.col("score") >= cut).cast("int"))
