import random
import sys

import numpy as np
import pytest

from tracewright.llm import minhash_hamming as m
from tracewright.llm.common import staged_rows


def plain(rows, width, percent=80):
    sets = {}
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        many = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
        sets[doc] = many or ({tuple(words)} if words else set())
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


@pytest.mark.parametrize("width", [4, 5])
def test_against_all_pairs(spark, width):
    rng = random.Random(width)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(25):
        base = [rng.choice(words) for _ in range(rng.choice((8, 60, 300)))]
        for _ in range(rng.choice((1, 4, 15))):
            copy = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 30) + 1)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows) * 3, rng.choice((" ", "\n", "\t ")).join(copy)))
    rows += [(1, None), (2, ""), (4, " \n"), (5, "one two"), (7, "ONE\vtwo"), (8, "two one"), (10, "x " * 20000),
             (11, "x " * 30000), (13, "Ééé a b c d"), (14, "ÉÉé a b c d")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id bigint, text string, kept string")
    found = m.near_duplicates(docs, width=width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == plain(rows, width)
    kept = m.first_of_each(docs, width=width)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, v in plain(rows, width).items() if v[2]}


def test_chains_join_though_their_least_member_is_far(spark):
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(words[i : i + 80]) for i in range(0, 21, 2)]
    rows = [(i + 10, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = m.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == plain(rows, 5)


def test_edges(spark):
    schema = "doc_id bigint, text string"
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f")], schema)
    rows = m.near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in rows) == [
        (0, 3, True), (0, 3, True), (3, 3, True), (3, 3, True)]
    assert m.near_duplicates(docs.limit(0)).count() == 0 and m.first_of_each(docs.limit(0)).count() == 0


def edited(base, places):
    return " ".join(w if i not in places else f"{w}x{places[i]}" for i, w in enumerate(base))


def test_far_pairs_of_a_large_group_are_not_compared(spark, monkeypatch):
    """Forty pairs of copies, each pair far from the 121 copies that are linked, share no rare shingle with these."""
    base = [f"w{i}" for i in range(150)]
    texts = [edited(base, {})] + [edited(base, {149: i}) for i in range(120)]
    rng = random.Random(3)
    for family in range(40):
        places = dict.fromkeys(rng.sample(range(10, 140, 6), 4), f"f{family}")
        texts += [edited(base, places | {0: f"m{family}.{i}"}) for i in range(2)]
    rows = list(enumerate(texts))
    counts, confirmed = [], m._confirmed

    def counted(docs, pairs, *rest):
        counts.append(pairs.count())
        return confirmed(docs, pairs, *rest)

    monkeypatch.setattr(m, "_confirmed", counted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = m.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == plain(rows, 5)
    assert counts[-1] < len(rows)


@pytest.mark.parametrize("holders", [2, 8])
def test_links_by_rare_and_by_common_shingles(spark, monkeypatch, holders):
    monkeypatch.setattr(m, "RARE_HOLDERS", holders)
    base, rng, texts = [f"w{i}" for i in range(100)], random.Random(9), []
    for _ in range(150):
        old = rng.choice(texts)[1] if texts and rng.random() < 0.4 else {}
        places = old | {rng.randrange(100): rng.randrange(1000) for _ in range(rng.choice((1, 2, 3)))}
        texts.append((edited(base, places), places))
    rows = [(i + 1, t) for i, (t, _) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = m.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == plain(rows, 5)


def jobs_of(spark, group, docs):
    """How many Spark jobs the query takes; each leaves threads and plans with the driver."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = m.first_of_each(docs).count()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_few_jobs(spark):
    rng = random.Random(4)
    far = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(80)]
    near = [t + f" end{i}" for t in far for i in range(2)]
    schema = "doc_id bigint, text string"
    found, jobs = jobs_of(spark, "far", spark.createDataFrame(list(enumerate(far)), schema))
    assert found == len(far) and jobs <= 40
    found, jobs = jobs_of(spark, "near", spark.createDataFrame(list(enumerate(near)), schema))
    assert found == len(far) and jobs <= 80


def test_rows_are_counted_while_written(spark):
    for rows in (spark.range(1000, numPartitions=7), spark.range(0), spark.range(9).where("id > 20").distinct()):
        found, number = staged_rows(rows, "x")
        assert number == found.count() == rows.count()


@pytest.mark.parametrize("size", [1, 250, 9000])
def test_minima_are_taken_in_few_calls(size):
    """A call for each of 2048 functions takes several times as long as the hashes themselves."""
    shingles = np.unique(np.random.default_rng(size).integers(0, 1 << 64, size, dtype=np.uint64))
    seeds, factors, calls = m._odd(2048, 5), m._odd(2048, 6), []
    sys.setprofile(lambda frame, event, arg: calls.append(event))
    try:
        found = m.minhashes(shingles, seeds, factors)
    finally:
        sys.setprofile(None)
    assert found.tolist() == [int(((shingles ^ s) * f).min()) for s, f in zip(seeds, factors)]
    assert len(calls) <= 50 + 8 * size * 2048 // 32_768


def test_shingle_sets_hold_each_shingle_once():
    factors = m._odd(4, 1)
    sets = [m.shingle_set(t, 4, factors) for t in ("a b c d a b c d a", "A b\tC d a\nb c", "a b c", "a b c a b c", " ")]
    assert [len(s) for s in sets] == [4, 4, 1, 3, 0]
    assert sets[0].tolist() == sets[1].tolist() == sorted(set(sets[0].tolist()))
