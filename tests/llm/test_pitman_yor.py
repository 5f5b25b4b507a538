import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.llm import pitman_yor as m


def corpus(count=240, seed=2):
    rng = random.Random(seed)
    follow = {f"w{i}": [f"w{(7 * i + k) % 60}" for k in range(4)] for i in range(60)}
    rows = []
    for doc in range(count):
        word, words = "w0", []
        for _ in range(rng.randrange(0, 80)):
            word = rng.choice(follow[word]) if rng.random() < 0.9 else f"r{rng.randrange(4000)}"
            words.append(word.upper() if rng.random() < 0.1 else word)
            word = word if word in follow else "w0"
        rows.append((doc, " ".join(words)))
    return rows


@pytest.mark.parametrize("size", [m.SHARD_BYTES, 2000])
def test_counts_base_and_gain(spark, size):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, score int")
    found = m.scored(docs, F.col("doc_id") % 5 != 1, shard_bytes=size).collect()
    counts = Counter()
    words = {i: (t or "").encode().lower().split() + [None] for i, t in rows}
    for i, w in words.items():
        if i % 5 != 1:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    assert len(found) == len(rows)
    for r in found:
        own = words[r.doc_id]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert r.learnt == (r.doc_id % 5 != 1) and math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0
    held = [r for r in found if not r.learnt]
    assert sum(r.score for r in held) > 0.75 * sum(r.base_score for r in held)


def test_probabilities_of_a_context_sum_to_one():
    learnt = ["a b", "a b", "a c", "b a c", "c", "a b c a b", "a b"]
    asked = ["a a b a c a unseen a", "b b c b a b unseen b", "c c a c b c unseen c", "unseen a unseen b unseen c unseen",
             "a", "b", "c", "unseen", ""]
    numbers, train = m.Numbers(), np.array([1] * len(learnt) + [0] * len(asked), dtype=np.uint8)
    (_, blob), = m.routed(*m.tokens(learnt + asked, numbers), train, numbers, 1, {})
    (_, sent), = m.seat(0, [blob], 1, [])
    (_, told), = m.menu(0, [0], [sent], 1)
    shard = m.Shard([blob])
    logs, base, known, total = m.pair_logs(shard, 0, {0: told}, 1, [])
    assert total == sum(len(t.split()) + 1 for t in learnt)
    sums = np.bincount(shard.context, 10**logs)
    several = np.bincount(shard.context, 1 - known) == 1  # with the unknown word as well
    full = np.bincount(shard.context) == 5
    assert (several & full).sum() >= 4
    assert np.allclose(sums[several & full], 1, atol=1e-6)


def seatings(c, d):
    """S(c, t) by the partitions of c customers into blocks, for t from 1 to c."""
    found = np.zeros(c)

    def place(sizes, weight, left):
        if not left:
            found[len(sizes) - 1] += weight
            return
        for i, n in enumerate(sizes):
            place([*sizes[:i], n + 1, *sizes[i + 1 :]], weight * (n - d), left - 1)
        place([*sizes, 1], weight, left - 1)

    place([], 1.0, c)
    return found


@pytest.mark.parametrize("d", [0.5, 0.8])
def test_numbers_of_seatings(d):
    rows = m.log_seatings([1, 3, 8, 600], d)
    for c in (1, 3, 8):
        assert np.allclose(np.exp(rows[c]), seatings(c, d))
    t = np.arange(1, 601)
    exact = rows[600] + t * np.log(d) + m.log_gamma(t + 1.0) - m.log_gamma(601.0)
    got, few = m.log_sizes(t, 600, d), t <= m.SUMMED * 600**d
    assert np.abs(got - exact)[few].max() < 1e-9 and np.abs(got - exact)[~few & (t < 300)].max(initial=0) < 0.1


@pytest.mark.parametrize("c, d, w", [(8, 0.5, 0.8), (8, 0.8, 2.0), (6, 0.8, 0.05), (2, 0.5, 1.0)])
def test_tables_follow_the_posterior(c, d, w):
    """Against all partitions of the customers, each with its probability."""
    chance = seatings(c, d) * w ** np.arange(1, c + 1)
    chance /= chance.sum()
    drawn = np.bincount(m.Dishes(np.full(40_000, c), d).reseated(np.full(40_000, w), np.random.default_rng(1)), minlength=c + 1)
    assert np.abs(drawn[1:] / 40_000 - chance).max() < 0.01
    assert m.Dishes(np.array([0, 1, 2]), 0.5).reseated(np.ones(3), np.random.default_rng(2))[:2].tolist() == [0, 1]


@pytest.mark.parametrize("w", [0.3, 20.0, 900.0])
def test_many_customers_like_the_table(w):
    rng, c = np.random.default_rng(4), 2500
    row = m.log_seatings([c], 0.8)[c] + np.log(w) * np.arange(1, c + 1)
    chance = np.exp(row - row.max()) / np.exp(row - row.max()).sum()
    mean = chance @ np.arange(1, c + 1)
    deviation = math.sqrt(chance @ (np.arange(1, c + 1) - mean) ** 2)
    drawn = [m.many_seated(c, w, 0.8, rng) for _ in range(400)]
    assert abs(np.mean(drawn) - mean) < 5 * deviation / 20
    assert 1 <= m.many_seated(10**9, 5.0, 0.8, rng) < 60


def test_gibbs_sweeps_follow_the_joint_posterior():
    """Two dishes of one restaurant: the scale makes them one draw."""
    counts, parent = (3, 4), (0.3, 0.1)
    joint = {}
    for a, x in enumerate(seatings(3, m.DISCOUNT), 1):
        for b, y in enumerate(seatings(4, m.DISCOUNT), 1):
            rising = math.prod(m.STRENGTH + m.DISCOUNT * k for k in range(a + b))
            joint[a, b] = x * y * parent[0] ** a * parent[1] ** b * rising
    total = sum(joint.values())
    rng, copies = np.random.default_rng(8), 6000
    shard = m.Shard.__new__(m.Shard)
    shard.counts = np.tile(np.array(counts), copies)
    shard.context, shard.word = np.repeat(np.arange(copies), 2), np.tile(np.array([0, 1]), copies)
    shard.contexts = np.arange(copies)
    seen = Counter()
    for sweep, tables in enumerate(shard.seated(np.array(parent), rng, 14)):
        if sweep > 3:
            seen.update(zip(tables[::2].tolist(), tables[1::2].tolist()))
    for pair, weight in joint.items():
        assert abs(seen[pair] / (10 * copies) - weight / total) < 0.01, pair


def test_probabilities_of_a_context_in_several_shards_sum_to_one():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)]
    learnt = [" ".join(f"a {rng.choice(vocabulary[: rng.randrange(1, 41)])}" for _ in range(60)) for _ in range(30)]
    asked = [" ".join(f"a {w}" for w in [*vocabulary, "a", "unseen"]), "a"]
    numbers, train = m.Numbers(), np.array([1] * len(learnt) + [0] * len(asked), dtype=np.uint8)
    tokens = m.tokens(learnt + asked, numbers)
    name = int(np.frombuffer(numbers.hashes, dtype=np.uint64)[numbers[b"a"]])
    shards, hot = 4, {name: 4}
    sent = list(m.routed(*tokens, train, numbers, shards, hot))
    held = {q: [b for s, b in sent if s == q] for q in range(shards)}
    menus = {q: ([], []) for q in range(shards)}
    for s in range(shards):
        for q, b in m.seat(s, held[s], shards, [name]):
            menus[q][0].append(s)
            menus[q][1].append(b)
    answers = {s: {} for s in range(shards)}
    for q, (senders, blobs) in menus.items():
        for s, b in m.menu(q, senders, blobs, shards):
            answers[s][q] = b
    total, unknown, words = 0.0, [], 0
    for s in range(shards):
        shard = m.Shard(held[s])
        logs, _, known, _ = m.pair_logs(shard, s, answers[s], shards, [name])
        own = shard.contexts[shard.context] == np.uint64(name)
        total, words = total + (10 ** logs[own & (known > 0)]).sum(), words + own.sum()
        unknown += (10 ** logs[own & (known == 0)]).tolist()
    assert words == 43 and np.ptp(unknown) < 1e-12
    assert abs(total + unknown[0] - 1) < 1e-6  # all known words, the end and one unknown


def test_scores_do_not_depend_on_partitions(spark):
    rows = corpus(120)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    key, found = "spark.sql.shuffle.partitions", []
    before = spark.conf.get(key)
    try:
        for parts in (2, 17):
            spark.conf.set(key, str(parts))
            scored = m.scored(docs.repartition(parts), F.col("doc_id") % 5 != 1, shard_bytes=3000)
            found.append({r.doc_id: r.score for r in scored.collect()})
    finally:
        spark.conf.set(key, before)
    assert all(math.isclose(found[0][i], found[1][i], rel_tol=1e-9) for i in found[0])


@pytest.mark.parametrize("texts", [["x " * 20000, "y"], ["x x y"] * 500])
def test_frequent_pairs_send_few_counts(texts):
    numbers, train = m.Numbers(), np.ones(len(texts), dtype=np.uint8)
    word, counts = m.tokens(texts, numbers)
    blobs = [b for _, b in m.routed(word, counts, train, numbers, 3, {})]
    assert sum(len(m.unpack(b, *m.TOKENS)[2]) for b in blobs) < 20
    assert sum(int(m.Shard([b]).counts.sum()) for b in blobs) == len(word)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (None, "a b"), (1, "a b"), (1, "a b"), (2, "x " * 50000)],
                                 "doc_id bigint, text string")
    rows = m.scored(docs, F.col("doc_id") == 1).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_known) for r in rows) == [
        (0, 3, 3), (1, 1, 1), (1, 3, 3), (1, 3, 3), (2, 50001, 1)]
    assert all(np.isfinite(r.score) for r in rows)
    none = m.scored(docs, F.lit(False)).collect()
    assert all(r.base_score == 0 and abs(r.score) < 1e-9 and r.train_tokens == 0 for r in none)
    assert m.scored(docs.limit(0), F.lit(True)).count() == 0
