import inspect
import random

import numpy as np
import pytest

from tracewright.llm import suffix_dedup as s


def plain(rows):
    first = {}
    for doc, raw in sorted(rows, key=lambda r: r[0]):
        for i in range(len(raw) - 49):
            first.setdefault(raw[i : i + 50], doc)
    out = []
    for doc, raw in rows:
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for i in range(len(raw) - 49):
            if first[raw[i : i + 50]] < doc:
                gone[i : i + 50] = True
        runs = int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if len(raw) else 0
        kept = np.frombuffer(raw, dtype=np.uint8)[~gone[: len(raw)]].tobytes()
        out.append((doc, len(raw), len(raw) - len(kept), runs, kept))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    words = [rng.choice(("ab", "cd", "é", "xyz")) * rng.randrange(1, 5) for _ in range(60)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randrange(5, 60))) for _ in range(12)]
    rows = []
    for doc in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choice(words) for _ in range(20))
                 for _ in range(rng.randrange(0, 6))]
        rows.append((doc, "\n".join(parts)))
    rows += [(100, "a" * 400), (90, "a" * 90), (101, "\0" * 200 + "q"), (102, "\0" * 120), (103, "z" * 49), (104, "z" * 49)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [
    {}, {"shard_bytes": 2000, "shard_windows": 700, "block_bytes": 3000}, {"block_bytes": 150},
])
def test_against_all_windows(spark, options):
    rows = corpus(len(options))
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id bigint, text string, n_spans int")
    found = s.without_repeats(docs, **options).collect()
    own = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found)
    assert own == plain([(d, t.encode()) for d, t in rows])


@pytest.mark.parametrize("options", [{}, {"block_bytes": 300}])
def test_hot_grams_against_all_windows(spark, options):
    rows = corpus(7)
    rows += [(200 + i, "a common phrase of more than sixteen bytes, then " + t) for i, (_, t) in enumerate(rows)]
    rows += [(400, "ab" * 300), (401, "ab" * 90 + "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = s.without_repeats(docs, shard_bytes=2000, hot_windows=40, **options).collect()
    own = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found)
    assert own == plain([(d, t.encode()) for d, t in rows])


def test_phrase_before_differing_text_is_spread(spark, monkeypatch):
    """A phrase in all documents with other text behind it: no shard takes all the windows over it."""
    rng = random.Random(4)
    texts = ["Copyright notice of all pages of the site | " + "".join(rng.choice("abcdefghij") for _ in range(80)) for _ in range(600)]
    texts += texts[:5]
    spans_of, kinds, unpacked = s.spans_of, s.KINDS, s.unpack

    def bounded(blocks, blobs, most):
        windows = sum(int(unpacked(b, *kinds)[5].sum()) for b in blobs)
        if windows > 2000:
            raise ValueError(f"{windows} windows in one shard")
        return spans_of(blocks, blobs, most)

    monkeypatch.setattr(s, "spans_of", bounded)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    options = {"shard_bytes": 4000, "block_bytes": 8000, "hot_windows": 1000}
    known = inspect.signature(s.without_repeats).parameters
    found = s.without_repeats(docs, **{k: v for k, v in options.items() if k in known}).collect()
    assert {r.doc_id: r.n_removed for r in found if r.n_removed} == {600 + i: len(texts[0]) for i in range(5)}


def test_nulls_and_repeated_ids(spark):
    long = "the same passage of more than fifty bytes stands in all of these rows"
    rows = [(None, long), (1, long), (1, long), (1, long + " x"), (2, None), (3, ""), (4, "new " + long + " new")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted((r.doc_id or 0, r.n_removed, r.n_spans) for r in s.without_repeats(docs).collect())
    assert found == [(0, 0, 0), (1, 0, 0), (1, 0, 0), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, len(long) + 1, 1)]
    assert s.without_repeats(docs.limit(0)).count() == 0
    texts = {r.doc_id: r.text for r in s.cleaned(docs).where("doc_id > 1").collect()}
    assert texts == {2: None, 3: "", 4: "new new"}


def test_cut_characters_go(spark):
    docs = spark.createDataFrame([(1, "é" + "x" * 60), (2, "è" + "x" * 60)], "doc_id bigint, text string")
    # The second byte of both letters differs, the windows begin behind it.
    rows = s.cleaned(docs).orderBy("doc_id").collect()
    assert rows[1].text == "è"


def test_order_and_prefixes():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1000:1300] = data[:300]
    places = np.arange(len(data) - s.LENGTH + 1)
    order, group = s.suffix_groups(data, places)
    raw = data.tobytes()
    texts = [raw[p : p + 50] for p in places[order]]
    assert texts == sorted(texts)
    assert (np.diff(group) == [a != b for a, b in zip(texts, texts[1:])]).all()
    left, right = rng.integers(0, 2900, 500), rng.integers(0, 2900, 500)

    def common(a, b):
        n = 0
        while n < 50 and raw[a + n] == raw[b + n]:
            n += 1
        return n

    assert s.common_prefixes(data, left, right).tolist() == [common(a, b) for a, b in zip(left, right)]
