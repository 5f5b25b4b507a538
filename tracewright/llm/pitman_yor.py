"""Language-model scores by a hierarchical Pitman-Yor model of word pairs.

Each context (the word before) is a restaurant; all of them share one parent
restaurant, whose base is uniform over the known words and one unknown word. Tables
of a context's restaurant are customers of the parent. A Gibbs sweep draws a scale
for each restaurant and then, given it, the tables of every dish from their exact
distribution (``Dishes.reseated``); the predictive probabilities are averaged over the
sweeps after the first.

Tokens move once, in packed blocks and as counts of a word pair in a document, to
the shard of their context, those of the documents to learn from and of all
documents to score together. A pair in more than ``PAIR_DOCS`` documents of a block
moves as one count; the block keeps the counts of its documents and takes the pair's
score from the answer, so a pair brings at most ``PAIR_DOCS`` counts a block. There

1. ``seat`` samples the context restaurants and sends each word's tables and
   count to the word's own shard,
2. ``menu`` samples the parent restaurant there and answers with the words'
   parent weights and counts,
3. ``score`` samples the context restaurants again, under the parent, and returns
   sums of log probabilities per document.

Frequent contexts are spread over several shards by the word that follows; their
totals travel with the words, and their probabilities use the sample that the totals
belong to, so they add up to one. Each shard samples such a context with its own
tables, and the parent's shards take their own totals for a share of all. What a task
holds is bounded by the number of shards, which follows the size of the corpus. Hot contexts are the only values
that pass through the driver: fewer than two for each shard.

Defined results: null and empty texts have one token, the end; a corpus without
documents to learn from gives the probability 1 to every token (both scores 0);
repeated rows are learnt from and scored one by one; null ids are scored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyspark
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pack, unpack, whole_text

BLOCK_CHARACTERS, SHARD_BYTES = 8 << 20, 16 << 20
# Words whose numbers a task keeps from block to block.
KNOWN_WORDS = 250_000
DISCOUNT, STRENGTH = 0.8, 1.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.5, 1.0
SWEEPS, FIRST_SWEEPS = 3, 2
# Documents of a block of which a word pair sends counts one by one.
PAIR_DOCS = 16
# Words are known by 48 bits of their hash, two of a billion words alike in about 2,000 cases.
HASH_BITS = 48
END = 0x4914F6CDD1D
_U = np.uint64


class Numbers(dict):
    """Consecutive numbers of words, and their hashes."""

    def __init__(self) -> None:
        super().__init__({None: 0})
        self.hashes = array("Q", [END])

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word) >> (64 - HASH_BITS))
        return number


def spread(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes * _U(0x9E3779B97F4A7C15)) >> _U(33)).astype(np.int64) % shards


def tokens(texts: list[str], numbers: Numbers) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers with an end (0) after each text; tokens of each text."""
    parts, end = [], np.zeros(1, dtype=np.int32)
    for text in texts:
        words = text.encode("utf-8").lower().split()
        parts += [np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words)), end]
    counts = np.array([len(p) + 1 for p in parts[::2]], dtype=np.int64)
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int32), counts


def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for batch in batches:
        sizes = batch["text"].str.len().to_numpy()
        cut = 0
        for i, n in enumerate(sizes.tolist(), 1):
            size += n
            if size >= BLOCK_CHARACTERS:
                yield pd.concat([*held, batch.iloc[cut:i]])
                held, size, cut = [], 0, i
        if cut < len(batch):
            held.append(batch.iloc[cut:])
    if held:
        yield pd.concat(held)


def counted(word: np.ndarray, counts: np.ndarray, train: np.ndarray) -> tuple[tuple, tuple]:
    """What a block sends: contexts, words, documents, times and times learnt from; and what it keeps.

    A pair in many documents is sent as one time of a document of its own, numbered behind the
    others; kept are the documents and times of these pairs, and how many documents each has.
    """
    n = len(counts)
    context = np.concatenate([[0], word[:-1]]).astype(np.int64)
    pairs, pair = np.unique(context << 32 | word, return_inverse=True)
    del context
    key, times = np.unique(pair * n + np.repeat(np.arange(n), counts), return_counts=True)
    pair, doc = key // n, key % n
    del key
    learnt = times * (train[doc] != 0)
    of_pair = np.bincount(pair, minlength=len(pairs))
    many = of_pair > PAIR_DOCS
    often = many[pair]
    rare, names = np.flatnonzero(~often), np.flatnonzero(many)
    rare = rare[np.argsort(doc[rare], kind="stable")]
    sums = np.bincount(pair[often], learnt[often], len(pairs)).astype(np.int64)[names]
    pair_, doc_ = np.concatenate([pair[rare], names]), np.concatenate([doc[rare], n + np.arange(len(names))])
    times_ = np.concatenate([times[rare], np.ones(len(names), dtype=np.int64)])
    sent = (pairs[pair_] >> 32, pairs[pair_] & 0xFFFFFFFF, doc_, times_, np.concatenate([learnt[rare], sums]))
    kept = tuple(a.astype(np.uint32) for a in (doc[often], times[often], of_pair[names]))
    return sent, kept


def routed(
    word: np.ndarray, counts: np.ndarray, train: np.ndarray, numbers: Numbers, shards: int, hot: dict[int, int],
    sent: tuple | None = None,
) -> Iterator[tuple[int, bytes]]:
    """(shard, packed counts) of a block, from what ``counted`` sends."""
    context, word, doc, times, learnt = counted(word, counts, train)[0] if sent is None else sent
    hashes = np.frombuffer(numbers.hashes, dtype=np.uint64).copy()
    place = hashes[context]
    for key, ways in hot.items():
        own = np.flatnonzero(place == _U(key))
        place[own] += (hashes[word[own]] >> _U(7)) % _U(ways) * _U(0xC2B2AE3D27D4EB4F)
    shard = spread(place, shards)
    if shards <= 1 << 16:
        shard = shard.astype(np.uint16)  # sorted by radix
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.append(True, shard[order][1:] != shard[order][:-1]))
    for a, b in zip(cuts, np.append(cuts[1:], len(order))):
        part = order[a:b]
        words, w = np.unique(word[part], return_inverse=True)
        contexts, u = np.unique(context[part], return_inverse=True)
        docs, many = np.unique(doc[part], return_counts=True)
        yield int(shard[part[0]]), pack(
            hashes[words], hashes[contexts], w.astype(np.uint32), u.astype(np.uint32),
            docs.astype(np.uint32), many.astype(np.uint32), times[part].astype(np.uint32),
            learnt[part].astype(np.uint32))


TOKENS = ("u8", "u8", "u4", "u4", "u4", "u4", "u4", "u4")


class Shard:
    """The pairs of one shard by document and the counts of those to learn from."""

    def __init__(self, blobs: list[bytes]) -> None:
        parts = [unpack(b, *TOKENS) for b in blobs]
        self.words, w = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        self.contexts, u = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
        keys, trains, self.docs, at_w, at_u = [], [], [], 0, 0
        for words, contexts, wi, ui, docs, many, times, learnt in parts:
            own_w, own_u = w[at_w : at_w + len(words)], u[at_u : at_u + len(contexts)]
            at_w, at_u = at_w + len(words), at_u + len(contexts)
            keys.append(own_u[ui].astype(np.int64) << 32 | own_w[wi])
            trains.append(learnt)
            self.docs.append((docs, many, times))
        del parts, w, u
        key, train = np.concatenate(keys), np.concatenate(trains)
        del keys, trains
        self.pairs, self.pair_of = np.unique(key, return_inverse=True)
        self.counts = np.bincount(self.pair_of, train, len(self.pairs)).astype(np.int64)
        self.pair_of = self.pair_of.astype(np.int32)
        del key, train
        self.context, self.word = self.pairs >> 32, self.pairs & 0xFFFFFFFF
        self.word_counts = np.bincount(self.word, self.counts, len(self.words)).astype(np.int64)
        self.customers = np.bincount(self.context, self.counts, len(self.contexts))

    def in_contexts(self, names: list[int]) -> np.ndarray:
        """Which pairs belong to one of the contexts."""
        at = at_sorted(self.contexts, np.array(names, dtype=np.uint64))
        return np.isin(self.context, at[at >= 0])

    def seated(self, parent: np.ndarray, rng: np.random.Generator, sweeps: int, pairs: np.ndarray | None = None):
        """Tables per pair after each sweep. parent: probability of each word.

        pairs: all pairs of some contexts; contexts are independent given the parent.
        """
        pairs = np.arange(len(self.counts)) if pairs is None else np.flatnonzero(pairs)
        counts, chance = self.counts[pairs], parent[self.word[pairs]]
        contexts, context = np.unique(self.context[pairs], return_inverse=True)
        dishes = Dishes(counts, DISCOUNT)
        tables = (counts > 0).astype(np.int64)
        for _ in range(sweeps):
            total = np.bincount(context, tables, len(contexts))
            scale = rng.gamma(STRENGTH / DISCOUNT + total)
            tables = dishes.reseated(DISCOUNT * scale[context] * chance, rng)
            yield tables


# Customers up to which the numbers of seatings are tabled.
TABLED = 2048
# Tables, as a multiple of customers ** discount, up to which the alternating sum is exact in doubles.
SUMMED = 2.0


def log_seatings(wanted: list[int], discount: float) -> dict[int, np.ndarray]:
    """By customers c the logs of the generalised Stirling numbers S(c, t) for t from 1 to c."""
    row, found = np.zeros(1), {}
    for c in range(1, max(wanted, default=0) + 1):
        if c in wanted:
            found[c] = row
        longer = np.append(-np.inf, row)
        longer[:-1] = np.logaddexp(longer[:-1], np.log(c - discount * np.arange(1, c + 1)) + row)
        row = longer
    return found


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive values."""
    x = np.asarray(x, dtype=np.float64)
    shift, low = 0.0, x < 8
    if low.any():
        y = np.where(low, x, 1)
        product = y * (y + 1) * (y + 2) * (y + 3) * (y + 4) * (y + 5) * (y + 6) * (y + 7)
        shift, x = np.where(low, -np.log(product), 0), np.where(low, x + 8, x)
    r = 1 / (x * x)
    return shift + (x - 0.5) * np.log(x) - x + 0.9189385332046727 + (
        1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / x


def log_sizes(tables: np.ndarray, customers: int, discount: float) -> np.ndarray:
    """Log of S(c, t) discount^t t! / c!: the chance that t independent Sibuya sizes add up to c.

    S has the generating function (1 - (1 - x)^discount)^t. Its binomial expansion is an
    alternating sum, exact in doubles for few tables. Beyond, where there are hundreds of
    tables, the saddle point of the generating function stands in; it is close unless
    nearly all customers sit alone, where the chances fall off in any case.
    """
    out = np.empty(len(tables))
    few = tables <= SUMMED * customers**discount
    t = tables[few].astype(np.float64)[:, None]
    if len(t):
        j = np.arange(1, min(int(t.max()), 200) + 1, dtype=np.float64)
        # 1 / Gamma(-a) = a sin(pi a) Gamma(a) / pi up to the sign, which follows below.
        sign = -np.sin(np.pi * j * discount) * np.where(j % 2 == 1, -1.0, 1.0)
        size = log_gamma(j * discount + 1) - np.log(np.pi) + log_gamma(customers - j * discount) - log_gamma(customers + 1.0)
        choose = log_gamma(t + 1) - log_gamma(j + 1)[None, :] - log_gamma(np.maximum(t - j, 0) + 1)
        logs = np.where(j <= t, choose + size, -np.inf)
        top = logs.max(axis=1, keepdims=True)
        total = (np.exp(logs - top) * sign).sum(axis=1)
        out[few] = np.log(np.maximum(total, 1e-300)) + top[:, 0]
    t = tables[~few].astype(np.float64)
    if len(t):
        def log_rest(s: np.ndarray) -> np.ndarray:
            """log(1 - exp(s))"""
            return np.where(s < -0.7, np.log1p(-np.exp(s)), np.log(np.maximum(-np.expm1(s), 1e-300)))

        def mean(s: np.ndarray) -> np.ndarray:
            rest = log_rest(s)
            return t * discount * np.exp(s + (discount - 1) * rest) / -np.expm1(discount * rest)

        low, high = np.full(len(t), -50.0), np.full(len(t), -1e-13)
        for _ in range(80):
            middle = (low + high) / 2
            above = mean(middle) > customers
            low, high = np.where(above, low, middle), np.where(above, middle, high)
        s = (low + high) / 2
        step = -s * 1e-4
        spread_ = (mean(s + step) - mean(s - step)) / (2 * step)
        value = t * np.log(-np.expm1(discount * log_rest(s)))
        out[~few] = value - s * customers - 0.5 * np.log(2 * np.pi * np.maximum(spread_, 1e-300))
    return out


def many_seated(customers: int, weight: float, discount: float, rng: np.random.Generator) -> int:
    """Tables of one dish with many customers: all values of t that matter, by their chances."""

    def logs(t: np.ndarray) -> np.ndarray:
        return t * np.log(weight / discount) - log_gamma(t + 1.0) + log_sizes(t, customers, discount)

    # The chances have one top: close in on it by ever finer grids.
    low, high = 1, customers
    while high - low > 64:
        grid = np.unique(np.geomspace(low, high, 33).astype(np.int64))
        best = int(logs(grid).argmax())
        after = int(grid[max(0, best - 1)]), int(grid[min(len(grid) - 1, best + 1)])
        if after == (low, high):
            break
        low, high = after
    grid = np.arange(low, high + 1)
    value = logs(grid)
    top = int(grid[value.argmax()])
    width = 16
    peak = value.max()
    while True:
        grid = np.arange(max(1, top - width), min(customers, top + width) + 1)
        value = logs(grid) - peak
        if (value[0] < -40 or grid[0] == 1) and (value[-1] < -40 or grid[-1] == customers):
            break
        width *= 2
    chance = np.cumsum(np.exp(value - value.max()))
    return int(grid[min(np.searchsorted(chance, rng.random() * chance[-1]), len(grid) - 1)])


class Dishes:
    """Dishes by their customers, with the numbers of seatings."""

    def __init__(self, counts: np.ndarray, discount: float) -> None:
        self.counts, self.discount = counts, discount
        self.order = np.argsort(counts, kind="stable")
        values, first = np.unique(counts[self.order], return_index=True)
        self.groups = list(zip(values.tolist(), first.tolist(), [*first[1:].tolist(), len(counts)]))
        self.rows = log_seatings([c for c in values.tolist() if 1 < c <= TABLED], discount)

    def reseated(self, weight: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Tables of each dish, drawn anew from their distribution given the customers: S(c, t) weight^t.

        All dishes of a restaurant are independent of each other given the scale that
        ``Shard.seated`` draws, a Gamma variable of the strength and of the number of
        tables: both draws together are a Gibbs sampler of the restaurant.
        """
        tables = (self.counts > 0).astype(np.int64)
        weight = np.maximum(weight, 1e-300)
        for c, a, b in self.groups:
            if c <= 1:
                continue
            if c > TABLED:
                for i in self.order[a:b]:
                    tables[i] = many_seated(c, float(weight[i]), self.discount, rng)
                continue
            t, step = np.arange(1, c + 1), max(1, 2_000_000 // c)
            for start in range(a, b, step):
                own = self.order[start : min(b, start + step)]
                logs = self.rows[c] + np.log(weight[own])[:, None] * t
                chance = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
                tables[own] = 1 + (chance < (rng.random(len(own)) * chance[:, -1])[:, None]).sum(axis=1)
        return tables


def first_tables(own: Shard, shard: int, hot: list[int], which: str) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of the hot or of all other contexts, and their tables in the first sample, always the same."""
    spread_out = own.in_contexts(hot)
    pairs = spread_out if which == "hot" else ~spread_out
    parent = (own.word_counts + 0.5) / (max(1, int(own.word_counts.sum())) + 0.5 * len(own.words))
    *_, tables = own.seated(parent, np.random.default_rng([shard, which == "hot"]), FIRST_SWEEPS, pairs)
    return pairs, tables


def seat(shard: int, blobs: list[bytes], shards: int, hot: list[int]) -> Iterator[tuple[int, bytes]]:
    """(shard of words, packed (words, tables, counts, of hot contexts: customers, tables))."""
    own = Shard(blobs)
    tables = np.zeros(len(own.pairs), dtype=np.int64)
    for which in ("hot", "other"):
        pairs, found = first_tables(own, shard, hot, which)
        tables[pairs] = found
    of_word = np.bincount(own.word, tables, len(own.words)).astype(np.int64)
    of_context = np.bincount(own.context, tables, len(own.contexts)).astype(np.int64)
    hot_at = at_sorted(own.contexts, np.array(hot, dtype=np.uint64))
    here = hot_at >= 0
    sums = [np.where(here, v[hot_at], 0).astype(np.int64) for v in (own.customers, of_context)]
    place = spread(own.words, shards)
    order = np.argsort(place, kind="stable")
    ends = np.searchsorted(place[order], np.arange(shards + 1))
    for q in range(shards):
        part = order[ends[q] : ends[q + 1]]
        yield q, pack(own.words[part], of_word[part].astype(np.uint32),
                      own.word_counts[part].astype(np.uint32), *sums)


def at_sorted(names: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value in sorted names, or -1."""
    if not len(names):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    return np.where(names[at] == wanted, at, -1)


def menu(q: int, senders: list[int], blobs: list[bytes], shards: int) -> Iterator[tuple[int, bytes]]:
    """(sender, packed answer): parent weights and counts in the order of the words sent."""
    parts = [unpack(b, "u8", "u4", "u4", "i8", "i8") for b in blobs]
    words, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    customers = np.bincount(at, np.concatenate([p[1] for p in parts]), len(words)).astype(np.int64)
    counts = np.bincount(at, np.concatenate([p[2] for p in parts]), len(words)).astype(np.int64)
    known = max(1, int((counts > 0).sum())) * shards  # of all shards, about
    rng = np.random.default_rng(q + (1 << 32))
    tables, mean = (customers > 0).astype(np.int64), np.zeros(len(words))
    dishes = Dishes(customers, PARENT_DISCOUNT)
    for sweep in range(SWEEPS + 1):
        scale = rng.gamma(PARENT_STRENGTH / PARENT_DISCOUNT + tables.sum() * shards)
        weight = PARENT_DISCOUNT * scale / (known + 1)
        tables = dishes.reseated(np.full(len(words), weight), rng)
        mean += tables * (sweep > 0) / SWEEPS
    sums = np.array([counts.sum(), (counts > 0).sum(), customers.sum(), mean.sum()], dtype=np.float64)
    own = np.where(customers > 0, customers - PARENT_DISCOUNT * mean, 0).astype(np.float32)
    cuts = np.cumsum([0, *[len(p[0]) for p in parts]])
    # The totals of hot contexts are the same for all: each answer carries them.
    hot = [sum(p[i] for p in parts) for i in (3, 4)]
    for sender, a, b in zip(senders, cuts, cuts[1:]):
        yield sender, pack(own[at[a:b]], counts[at[a:b]].astype(np.uint64), sums, *hot)


def pair_logs(
    own: Shard, shard: int, answers: dict[int, bytes], shards: int, hot: list[int]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Per pair the log probability, the base's, whether the word is known; all tokens learnt from."""
    weight, counts, sums = np.zeros(len(own.words)), np.zeros(len(own.words)), np.zeros(4)
    place = spread(own.words, shards)
    order = np.argsort(place, kind="stable")
    ends = np.searchsorted(place[order], np.arange(shards + 1))
    hot_sums = [np.zeros(len(hot)), np.zeros(len(hot))]
    for q, blob in answers.items():
        part = order[ends[q] : ends[q + 1]]
        weight[part], counts[part], some, *hot_sums = unpack(blob, "f4", "u8", "f8", "i8", "i8")
        sums += some
    learnt, known, customers, tables = sums
    new = (PARENT_STRENGTH + PARENT_DISCOUNT * tables) / (known + 1)
    parent = (weight + new) / (PARENT_STRENGTH + customers) if learnt else np.ones(len(own.words))
    total = own.customers.astype(np.float64)
    mean = np.zeros(len(own.pairs))
    # Contexts in several shards: the first sample again, as its totals are known.
    spread_out, before = first_tables(own, shard, hot, "hot")
    mean[spread_out] = before
    rng = np.random.default_rng([shard, 2])
    for sweep, tables in enumerate(own.seated(parent, rng, SWEEPS + 1, ~spread_out)):
        mean[~spread_out] += tables * (sweep > 0) / SWEEPS
    of_context = np.bincount(own.context, mean, len(own.contexts))
    hot_at = at_sorted(own.contexts, np.array(hot, dtype=np.uint64))
    here = np.flatnonzero(hot_at >= 0)
    total[hot_at[here]], of_context[hot_at[here]] = hot_sums[0][here], hot_sums[1][here]
    back = (STRENGTH + DISCOUNT * of_context)[own.context] * parent[own.word]
    direct = np.maximum(own.counts - DISCOUNT * mean, 0)
    logs = np.log10((direct + back) / (STRENGTH + total[own.context]))
    logs[total[own.context] == 0] = np.log10(parent[own.word[total[own.context] == 0]])
    base = np.log10((counts + 0.5) / (learnt + 0.5 * (known + 1)))[own.word]
    return logs, base, (counts > 0).astype(np.float64)[own.word], learnt


def score(
    shard: int, names: list[str], blobs: list[bytes], answers: dict[int, bytes], shards: int, hot: list[int]
) -> Iterator[tuple[str, bytes]]:
    """(block, packed (document, sum of scores, of base scores, of known tokens, all tokens learnt from))."""
    own = Shard(blobs)
    *values, learnt = pair_logs(own, shard, answers, shards, hot)
    at = 0
    for name, (docs, many, times) in zip(names, own.docs):
        pair = own.pair_of[at : at + int(many.sum())]
        at += len(pair)
        first = np.cumsum(many, dtype=np.int64) - many
        yield name, pack(docs, *[np.add.reduceat(v[pair] * times, first) for v in values], np.array([learnt]))


def contexts_above(rows: DataFrame, shards: int) -> dict[int, int]:
    """Contexts with over half of a shard's share of all tokens, and over how many shards to spread them.

    Counted over all texts; a block drops words below a sixteenth of a share of its own.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches):
            numbers = Numbers()
            word, _ = tokens(block["text"].tolist(), numbers)
            counts = np.bincount(word)
            top = np.flatnonzero(counts >= len(word) / (16 * shards))
            hashes = np.frombuffer(numbers.hashes, dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({
                "word": [None, *hashes[top].tolist()], "count": [len(word), *counts[top].tolist()]
            }).astype({"word": "Int64"})

    counted = rows.mapInPandas(count, "word bigint, count bigint").groupBy("word").agg(F.sum("count").alias("n"))
    total = counted.where("word is null").first()
    if total is None:
        return {}
    limit = total["n"] / (2 * shards)
    found = counted.where(F.col("word").isNotNull() & (F.col("n") > limit)).collect()
    return {r["word"] % (1 << 64): int(-(-r["n"] // limit)) for r in found}


def scored(
    docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """id, learnt (whether ``train`` holds), n_tokens, n_known, train_tokens, base_score, score."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    # By the data alone: the sample must not depend on the session's partitions.
    shards = max(1, int(-(-size // shard_bytes)))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(train, F.lit(False)).alias("train"),
        whole_text(text_col).alias("text"))
    hot = contexts_above(rows.select("text"), shards)
    hot_names = sorted(hot)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, numbers = pyspark.TaskContext.get().partitionId(), Numbers()
        for number, block in enumerate(blocks(batches)):
            if len(numbers) > KNOWN_WORDS:
                numbers = Numbers()
            name = f"{task}-{number}"
            word, counts = tokens(block["text"].tolist(), numbers)
            learnt = block["train"].to_numpy(dtype=np.uint8)
            ids = block["id"].astype("Int64")
            found, kept = counted(word, counts, learnt)
            about = pack(
                ids.isna().to_numpy(dtype=np.uint8), ids.fillna(0).to_numpy(dtype=np.int64), learnt, counts, *kept)
            sent = [(s, name, False, b) for s, b in routed(word, counts, learnt, numbers, shards, hot, found)]
            sent.append((number % shards, name, True, about))
            yield pd.DataFrame(sent, columns=["shard", "block", "about", "body"])

    def run_seat(part: pd.DataFrame) -> pd.DataFrame:
        part = part[~part["about"]].sort_values("block")
        if not len(part):
            return pd.DataFrame({"word_shard": [], "sender": [], "body": []})
        shard = int(part["shard"].iloc[0])
        out = [(q, shard, b) for q, b in seat(shard, part["body"].tolist(), shards, hot_names)]
        return pd.DataFrame(out, columns=["word_shard", "sender", "body"])

    def run_menu(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("sender")
        q = int(part["word_shard"].iloc[0])
        out = [(s, q, b) for s, b in menu(q, part["sender"].tolist(), part["body"].tolist(), shards)]
        return pd.DataFrame(out, columns=["shard", "word_shard", "body"])

    def run_score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [(n, True, b) for n, b in zip(left["block"][left["about"]], left["body"][left["about"]])]
        left = left[~left["about"]].sort_values("block")
        if len(left):
            answers = dict(zip(right["word_shard"].tolist(), right["body"].tolist()))
            shard = int(left["shard"].iloc[0])
            found = score(shard, left["block"].tolist(), left["body"].tolist(), answers, shards, hot_names)
            out += [(n, False, b) for n, b in found]
        return pd.DataFrame(out, columns=["block", "about", "body"])

    def run_sum(part: pd.DataFrame) -> pd.DataFrame:
        missing, ids, learnt, tokens_, docs_, times, many = unpack(
            part["body"][part["about"]].iloc[0], "u1", "i8", "u1", "i8", "u4", "u4", "u4")
        sums, total = np.zeros((3, len(ids) + len(many))), 0.0
        for blob in sorted(part["body"][~part["about"]]):
            found, *values, learnt_from = unpack(blob, "u4", "f8", "f8", "f8", "f8")
            for row, value in zip(sums, values):
                row[found] += value
            total = float(learnt_from[0])
        # Behind the documents: the scores of the pairs that the block kept the counts of.
        sums = [row[: len(ids)] + np.bincount(docs_, times * np.repeat(row[len(ids) :], many), len(ids)) for row in sums]
        return pd.DataFrame({
            id_col: pd.Series(ids).astype("Int64").mask(missing.astype(bool)),
            "learnt": learnt.astype(bool), "n_tokens": tokens_, "n_known": sums[2].astype(np.int64),
            "train_tokens": int(total), "base_score": sums[1], "score": sums[0]})

    sent = rows.mapInPandas(route, "shard int, block string, about boolean, body binary")
    seated = sent.groupBy("shard").applyInPandas(run_seat, "word_shard int, sender int, body binary")
    answered = seated.groupBy("word_shard").applyInPandas(run_menu, "shard int, word_shard int, body binary")
    summed = sent.groupBy("shard").cogroup(answered.groupBy("shard")).applyInPandas(
        run_score, "block string, about boolean, body binary")
    return summed.groupBy("block").applyInPandas(
        run_sum, f"{id_col} bigint, learnt boolean, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double")
