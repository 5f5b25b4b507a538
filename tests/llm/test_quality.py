import random

import numpy as np
import pytest

from tracewright.llm import quality as q

SCHEMA = "doc_id bigint, text string"


def texts(seed, count):
    """(text, quality): prose, and the same with marks, capitals or repeated words."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioubdgklmnrst") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    out = []
    for _ in range(count):
        own = [rng.choice(words) for _ in range(rng.randrange(20, 200))]
        kind = rng.choice((0, 0, 0, 1, 2, 3))
        if kind == 1:
            own = [w + rng.choice(("###", "%%%")) for w in own]
        elif kind == 2:
            own = [w.upper() + "!!" for w in own]
        elif kind == 3:
            own = [w for w in own for _ in range(5)]
        out.append((" ".join(own).capitalize() + ".", int(kind == 0)))
    return out


@pytest.fixture(scope="module")
def learnt(spark):
    rows = texts(1, 600)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], SCHEMA).repartition(6)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows) if i % 3], "doc_id bigint, quality int")
    return rows, docs, labels, q.fit(docs, labels)


def test_held_out_documents(learnt):
    rows, docs, _, model = learnt
    found = {r.doc_id: r for r in q.scored(docs, model).collect()}
    held = [(found[i], y) for i, (_, y) in enumerate(rows) if not i % 3]
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found.values())
    assert sum(r.predicted == y for r, y in held) / len(held) > 0.97


def test_neighbours_against_all_products(learnt):
    """Plain loops over all labelled vectors give the scores."""
    rows, _, _, model = learnt
    vectors = []
    for text, _ in rows[:60]:
        place, count = q.terms(text, q.Words())
        vectors.append(model.project(place, count))
    found = model.scores(np.stack(vectors))
    for vector, score in zip(vectors, found):
        like = [(round(float(vector @ v / np.linalg.norm(vector)) * (1 << 30)), -i) for i, v in enumerate(model.vectors)]
        votes = [0.0, 0.0]
        for near, i in sorted(like, reverse=True)[: q.NEIGHBOURS]:
            y = model.labels[-i]
            votes[y] += max(0, near / (1 << 30)) ** q.SHARPNESS * model.votes[y]
        assert score == pytest.approx(votes[1] / sum(votes), abs=1e-6)


def test_latent_space_is_the_decomposition():
    rng = np.random.default_rng(2)
    rows, dense = [], np.zeros((40, q.TERMS))
    for i in range(40):
        place = np.sort(rng.choice(60, 12, replace=False))
        weight = rng.random(12) + (place % 3 == i % 3) * 4
        rows.append((place, weight))
        dense[i, place] = weight
    right = q.latent(rows, 3)
    exact = np.linalg.svd(dense, full_matrices=False)[2][:3]
    assert np.abs(right.T @ exact.T).max(axis=1) == pytest.approx(1, abs=5e-3)


def test_frequencies_cover_all_documents(spark):
    rows = texts(4, 90) + [("", 1), (None, 1)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], SCHEMA).repartition(5)
    total, seen = q.document_frequencies(docs, "text")
    plain = np.zeros(q.TERMS)
    for text, _ in rows:
        plain[q.terms(text or "", q.Words())[0]] += 1
    assert total == len(rows) and (seen == plain).all()


def test_long_texts_are_counted_whole(monkeypatch):
    text = "one two two Three\nfour four. " * 50
    whole = q.terms(text, q.Words())
    monkeypatch.setattr(q, "PIECE_WORDS", 150)
    cut = q.terms(text, q.Words())
    words = [p < q.STARTS[2] or p >= q.STARTS[3] for p in whole[0]]
    kept = dict(zip(*cut))
    assert all(kept[p] == n for p, n, w in zip(*whole, words) if w)


def test_edges(spark, learnt):
    _, _, labels, model = learnt
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (4, "x " * 300_000), (4, "x " * 300_000)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'s' as score", "0 as place", "1 as quality", "'t' as _text")
    found = q.scored(docs, model)
    assert found.columns == [*docs.columns, "predicted"]
    got = {r.doc_id: (r.score, r.predicted) for r in found.collect()}
    assert got[1] == got[2] == got[3] == (pytest.approx(model.share), 1) and found.count() == 6
    assert q.scored(docs.limit(0), model).count() == 0
    for some, share in ((labels.limit(0), 0), (labels.where("quality = 1"), 1)):
        own = q.fit(docs, some)
        assert {r.score for r in q.scored(docs, own).collect()} == {share}
    share = labels.selectExpr("avg(quality)").first()[0]
    assert {r.score for r in q.scored(docs, q.fit(docs.limit(0), labels)).collect()} == {share}
