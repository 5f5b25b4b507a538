"""Toxic spans by a linear-chain conditional random field.

Tokens are words between ASCII white space, compared in lower case without
punctuation at their ends. The chain has two labels; its features are the word,
its first three to six and last three characters and the words beside it, hashed
into a fixed table.

Labelled tokens come from labelled documents: in toxic documents, words are marked
if they, or their first characters, occur there in many more distinct surroundings
than elsewhere (distinct, so that copies do not count twice). The chain is fitted
on a bounded sample of labelled rows (``FIT_TOXIC``, ``FIT_OTHER``, texts up to
``FIT_CHARACTERS``, of which the chain sees those up to ``CHAIN_CHARACTERS``); scoring
takes whole texts. Forward-backward marginals p give
the document's features, the sum of p squared and the length, which a logistic
curve turns into a score; tokens with p of at least one half are the offending
spans.

Defined results: null and empty texts have the score of a text without any
offending token; without labels of both kinds every score is the share of toxic
labels (0 without labels); a document labelled twice is toxic if one label says
so; null labels and ids are not learnt from. Repeated rows are scored alike.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import trim_memory, whole_text

FIT_TOXIC, FIT_OTHER, FIT_CHARACTERS = 1600, 2400, 1 << 18
# The chain learns from texts of the sample up to this length, the curve from longer ones as well.
CHAIN_CHARACTERS = 1 << 13
TABLE, ROUNDS, PRIOR, PACE = 1 << 20, 30, 1.0, 0.4
# A word is marked if toxic documents have it, with this many deviations to spare, so many times as often.
DEVIATIONS, TIMES = 2.5, 3.0
# What missing a toxic document costs against rejecting another.
MISS_COST = 2.5
STEMS = (3, 4, 5, 6)
LANE = 128
WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(word: bytes) -> str:
    """The word in lower case without what is no letter or digit at its ends."""
    text = word.decode("utf-8").lower()
    low, high = 0, len(text)
    while low < high and unicodedata.category(text[low])[0] not in "LN":
        low += 1
    while high > low and unicodedata.category(text[high - 1])[0] not in "LN":
        high -= 1
    return text[low:high]


def places(word: str) -> tuple[int, ...]:
    """Table places of a word as left and right neighbour, as itself, its end and its stems."""
    marks = [f"l {word}", f"r {word}", f"w {word}", f"e {word[-3:]}"]
    marks += [f"{n} {word[:n]}" if len(word) > n else "" for n in STEMS]
    return tuple(xxhash.xxh3_64_intdigest(m) % (TABLE - 1) + 1 if m else 0 for m in marks)


class Words(dict):
    """Numbers of words as they occur, with the table places of each."""

    def __init__(self) -> None:
        super().__init__()
        self.flat = array("i")

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.flat.extend(places(plain(word)))
        return number

    @property
    def places(self) -> np.ndarray:
        """Table places by word number."""
        return np.array(self.flat, dtype=np.int32).reshape(len(self), -1)

    def trimmed(self, most: int = 100_000) -> "Words":
        return Words() if len(self) > most else self


def tokens(texts: list[str], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts and how many each text has."""
    parts = []
    for text in texts:
        own = text.encode("utf-8").lower().split()
        parts.append(np.fromiter(map(words.__getitem__, own), dtype=np.int32, count=len(own)))
    counts = np.array([len(p) for p in parts], dtype=np.int64)
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int32), counts


def chain(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """x_t = (c_t + d_t x_(t-1)) / (a_t + b_t x_(t-1)) for all t, from x = 1.

    Lanes of LANE steps run side by side: first the map of each whole lane, then
    the start of each lane, then all steps.
    """
    n = len(a)
    lanes = -(-n // LANE)
    a, b, c, d = (np.append(v, np.full(lanes * LANE - n, f)).reshape(lanes, LANE).T.copy()
                  for v, f in ((a, 1.0), (b, 0.0), (c, 1.0), (d, 0.0)))
    m = [np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes)]  # d, c, b, a of the lane
    for t in range(LANE):
        m = [d[t] * m[0] + c[t] * m[2], d[t] * m[1] + c[t] * m[3],
             b[t] * m[0] + a[t] * m[2], b[t] * m[1] + a[t] * m[3]]
        size = np.maximum(np.maximum(m[0], m[1]), np.maximum(m[2], m[3]))
        m = [v / size for v in m]
    starts = list(accumulate(
        zip(*(v.tolist() for v in m)), lambda x, k: (k[0] * x + k[1]) / (k[2] * x + k[3]), initial=1.0))
    x = np.array(starts[:lanes])
    out = np.empty((LANE, lanes))
    for t in range(LANE):
        x = (c[t] + d[t] * x) / (a[t] + b[t] * x)
        out[t] = x
    return out.T.reshape(-1)[:n]


class Field:
    """Weights of the chain: table, transition scores from (0, 1) to (0, 1), start score, bias."""

    def __init__(self) -> None:
        self.table = np.zeros(TABLE)
        self.steps = np.zeros((2, 2))
        self.start = np.zeros(2)  # score of a start in label 1, score of label 1 at all

    def emission(self, numbers: np.ndarray, counts: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Score of label 1 of each token; table: the places of each word."""
        left, right, own = self.table[table[:, 0]], self.table[table[:, 1]], self.table[table[:, 2:]].sum(axis=1)
        out = own[numbers] + self.start[1]
        first, last = bounds(counts)
        beside = left[numbers[:-1]]
        beside[last[last < len(numbers) - 1]] = 0
        out[1:] += beside
        beside = right[numbers[1:]]
        beside[first[first > 0] - 1] = 0
        out[:-1] += beside
        return np.clip(out, -25, 25)

    def marginals(self, emission: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probability of label 1, forward odds, backward odds) of each token."""
        step, odds = np.exp(self.steps), np.exp(emission)
        first, last = bounds(counts)
        a, b = np.full(len(odds), step[0, 0]), np.full(len(odds), step[1, 0])
        c, d = odds * step[0, 1], odds * step[1, 1]
        a[first], b[first], c[first], d[first] = 1, 0, odds[first] * np.exp(self.start[0]), 0
        forward = chain(a, b, c, d)
        after = np.append(odds[1:], 1.0)
        a, b = np.full(len(odds), step[0, 0]), step[0, 1] * after
        c, d = np.full(len(odds), step[1, 0]), step[1, 1] * after
        a[last], b[last], c[last], d[last] = 1, 0, 1, 0
        backward = chain(a[::-1], b[::-1], c[::-1], d[::-1])[::-1]
        both = forward * backward
        return both / (1 + both), forward, backward


def bounds(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last token of each text that has any."""
    ends = np.cumsum(counts)[counts > 0]
    return ends - counts[counts > 0], ends - 1


def marked_words(numbers: np.ndarray, counts: np.ndarray, toxic: np.ndarray, words: Words) -> np.ndarray:
    """Whether each word number is one that toxic documents have in many more surroundings."""
    numbers = numbers.astype(np.int64)
    before = np.append(-1, numbers[:-1]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    after = np.append(numbers[1:], -1).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    label = np.repeat(toxic, counts)
    marked = np.zeros(len(words), dtype=bool)
    texts = [plain(w) for w in words]  # in the order of their numbers
    for size in (None, *STEMS):
        units: dict[str, int] = {"": 0}
        unit = np.array([
            units.setdefault(w[:size] if size is None or len(w) > size else "", len(units)) for w in texts
        ], dtype=np.int64)
        own = unit[numbers]
        around = (before ^ after) + own.astype(np.uint64) * np.uint64(0xFF51AFD7ED558CCD)
        first = np.unique(around ^ (label.astype(np.uint64) << np.uint64(63)), return_index=True)[1]
        seen = np.zeros((2, len(units)))
        np.add.at(seen, (label[first], own[first]), 1)
        total = np.maximum(1, seen.sum(axis=1))
        low = (seen[1] - DEVIATIONS * np.sqrt(seen[1])) / total[1]
        high = (seen[0] + DEVIATIONS * np.sqrt(seen[0]) + 2) / total[0]
        found = low >= TIMES * high
        found[0] = False
        marked |= found[unit]
    return marked


def fitted(texts: list[str], toxic: list[int], share: float | None = None) -> tuple[Field, np.ndarray]:
    """The chain, fitted on two thirds of the texts, and the curve, fitted on the rest.

    share: that of toxic texts among all that the sample stands for.
    """
    field, label = Field(), np.array(toxic, dtype=np.int64)
    learn = np.arange(len(texts)) % 3 < 2
    short = learn & np.array([len(t) <= CHAIN_CHARACTERS for t in texts], dtype=bool)
    words = Words()
    numbers, counts = tokens([t for t, p in zip(texts, short) if p], words)
    if not len(numbers) or len({*label[short]}) < 2:
        share = float(label.mean() if share is None else share) if len(label) else 0.0
        field.start[1] = -25.0  # no token is known to offend
        return field, np.array([0.0, 0.0, np.log((share + 1e-9) / (1 - share + 1e-9))])
    _descend(field, numbers, counts, label[short], words)
    rest = ~learn if len({*label[~learn]}) == 2 else short
    rows = [
        text_features(field, block, Words())
        for block in text_blocks([t for t, p in zip(texts, rest) if p], CHAIN_CHARACTERS << 7)
    ]
    own = label[rest].mean()
    share = own if share is None else share
    weight = np.where(label[rest] == 1, MISS_COST * share / own, (1 - share) / (1 - own))
    return field, logistic(np.concatenate([r for r, _, _ in rows]), label[rest], weight)


def text_features(field: Field, texts: list[str], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the texts, marginals of all their tokens, tokens of each text."""
    numbers, counts = tokens(texts, words)
    p = np.zeros(0)
    if len(numbers):
        p = field.marginals(field.emission(numbers, counts, words.places), counts)[0]
    return features(p, counts), p, counts


def _descend(field: Field, numbers: np.ndarray, counts: np.ndarray, label: np.ndarray, words: Words) -> None:
    """Damped diagonal Newton steps on the likelihood of the marked tokens, with a normal prior."""
    table = words.places
    marked = marked_words(numbers, counts, label, words)
    y = (marked[numbers] & (np.repeat(label, counts) == 1)).astype(np.int64)
    first, last = bounds(counts)
    left, right = np.ones(len(y), dtype=bool), np.ones(len(y), dtype=bool)
    left[first], right[last] = False, False
    inner = np.flatnonzero(right)
    field.start[1] = np.log((y.sum() + 1) / len(y))

    def by_place(value: np.ndarray) -> np.ndarray:
        sums = [np.bincount(numbers[:-1], np.where(left[1:], value[1:], 0), len(table)),
                np.bincount(numbers[1:], np.where(right[:-1], value[:-1], 0), len(table))]
        sums += [np.bincount(numbers, value, len(table))] * (table.shape[1] - 2)
        out = sum(np.bincount(table[:, i], s, TABLE) for i, s in enumerate(sums))
        out[0] = 0
        return out

    truth = np.bincount(2 * y[inner] + y[inner + 1], minlength=4)
    for _ in range(ROUNDS):
        emission = field.emission(numbers, counts, table)
        p, forward, backward = field.marginals(emission, counts)
        error, curve = p - y, p * (1 - p)
        ahead = np.exp(emission[inner + 1]) * backward[inner + 1]
        step = np.exp(field.steps)
        here = forward[inner]
        pair = np.stack([np.full(len(inner), step[0, 0]), step[0, 1] * ahead,
                         step[1, 0] * here, step[1, 1] * here * ahead])
        del emission, forward, backward, here, ahead
        pair /= pair.sum(axis=0)
        for value, slope, bend in (
            (field.table, by_place(error), by_place(curve)),
            (field.steps, (pair.sum(axis=1) - truth).reshape(2, 2), (pair * (1 - pair)).sum(axis=1).reshape(2, 2)),
            (field.start, np.array([error[first].sum(), error.sum()]), np.array([curve[first].sum(), curve.sum()])),
        ):
            value -= PACE * np.clip((slope + PRIOR * value) / (bend + PRIOR), -2, 2)
    field.table[0] = 0


def features(p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text the logs of the sum of squared marginals and of the length, and 1."""
    sums = np.bincount(np.repeat(np.arange(len(counts)), counts), p * p, len(counts))
    return np.stack([np.log(sums + 1e-3), np.log(counts + 20.0), np.ones(len(counts))], axis=1)


def logistic(rows: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients of a logistic curve."""
    value = np.zeros(rows.shape[1])
    prior = np.diag([0.1, 0.1, 0.01])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(rows @ value, -30, 30)))
        slope = rows.T @ (weight * (p - label)) + prior @ value
        curve = (rows * (weight * p * (1 - p))[:, None]).T @ rows + prior
        value = value - np.clip(np.linalg.solve(curve, slope), -2, 2)
    return value


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple:
    """Plain values of a model. labels: id and ``toxic``, only the rows to learn from."""
    named = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull())
    named = named.groupBy(id_col).agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64(F.col(id_col))
    rows = [
        named.where(F.col("toxic") == y).orderBy(order).limit(n)
        for y, n in ((1, FIT_TOXIC), (0, FIT_OTHER))
    ]
    # At most FIT_TOXIC + FIT_OTHER ids: bounded by constants.
    picked = F.broadcast(rows[0].unionByName(rows[1]))
    text = whole_text(text_col).alias("_text")
    sample = docs.select(F.col(id_col), text).where(F.length("_text") <= FIT_CHARACTERS).join(picked, id_col)
    found = sample.groupBy("_text").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("_text")).toPandas()
    share = named.agg(F.avg("toxic")).first()[0]
    field, curve = fitted(found["_text"].tolist(), found["toxic"].tolist(), share)
    # The driver stays while later stages run: it keeps the model, not the memory of the fit.
    del found
    trim_memory()
    return field.table, field.steps, field.start, curve


def scored(docs: DataFrame, model: tuple, text_col: str = "text") -> DataFrame:
    """Add score, predicted and spans (start, end, p; in characters); such columns are replaced."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, predicted int, spans array<struct<start: int, end: int, p: double>>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        field, words = Field(), Words()
        field.table, field.steps, field.start, curve = held.value
        for batch in batches:
            out = []
            for texts in text_blocks(batch):
                words = words.trimmed()
                rows, p, counts = text_features(field, texts, words)
                scores = 1 / (1 + np.exp(-np.clip(rows @ curve, -500, 500)))
                ends = np.cumsum(counts)
                hits = np.flatnonzero(p >= 0.5)
                low, high = np.searchsorted(hits, ends - counts), np.searchsorted(hits, ends)
                for i, text in enumerate(texts):
                    own = hits[low[i] : high[i]]
                    out.append((scores[i], int(scores[i] >= 0.5), _spans(text, own - ends[i] + counts[i], p[own])))
            yield pd.DataFrame(out, columns=["score", "predicted", "spans"])

    found = docs.withColumn("_scored", score(whole_text(text_col)))
    names = ("score", "predicted", "spans")
    return found.withColumns({n: F.col(f"_scored.{n}") for n in names}).drop("_scored")


def _spans(text: str, places: np.ndarray, p: np.ndarray) -> list[dict]:
    """Runs of adjacent offending words as character ranges."""
    if not len(places):
        return []
    wanted, out = dict(zip(places.tolist(), p.tolist())), []
    for number, found in enumerate(WORD.finditer(text)):
        if number not in wanted:
            continue
        if out and number - 1 in wanted:
            out[-1]["end"] = found.end()
            out[-1]["p"] = max(out[-1]["p"], wanted[number])
        else:
            out.append({"start": found.start(), "end": found.end(), "p": wanted[number]})
        if number == places[-1]:
            break
    return out


def text_blocks(texts: Iterable[str], characters: int = 2 << 20) -> Iterator[list[str]]:
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text)
        if size >= characters:
            yield block
            block, size = [], 0
    if block:
        yield block
