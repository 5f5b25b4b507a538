import random

import numpy as np
import pytest

from tracewright.llm import toxicity as t


def chain_of(e, starts, steps, start):
    """Marginals by summing over all labellings, text by text."""
    out = []
    ends = [*starts[1:], len(e)]
    for a, b in zip(starts, ends):
        weight = np.zeros((b - a, 2))
        for code in range(1 << (b - a)):
            y = [(code >> i) & 1 for i in range(b - a)]
            s = start * y[0] + sum(e[a + i] for i in range(b - a) if y[i])
            s += sum(steps[y[i], y[i + 1]] for i in range(b - a - 1))
            for i, v in enumerate(y):
                weight[i, v] += np.exp(s)
        out += (weight[:, 1] / weight.sum(axis=1)).tolist()
    return np.array(out)


@pytest.mark.parametrize("lane", [1, 3, 128])
def test_marginals(monkeypatch, lane):
    monkeypatch.setattr(t, "LANE", lane)
    rng = np.random.default_rng(lane)
    field = t.Field()
    field.steps, field.start = rng.normal(size=(2, 2)), np.array([0.7, 0.0])
    counts = np.array([0, 5, 1, 0, 8, 3])
    e = rng.normal(size=counts.sum()) * 2
    p = field.marginals(e, counts)[0]
    assert np.allclose(p, chain_of(e, [0, 5, 6, 14], field.steps, 0.7))


def corpus(count, seed):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randrange(2, 9))) for _ in range(800)]
    rows = []
    for doc in range(count):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 200))]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(["Blarg!", "zwonk", "qux" + rng.choice(plain)]))
        rows.append((doc, " ".join(words), toxic))
    return rows


def test_held_out_accuracy_and_spans(spark):
    rows = corpus(900, 5)
    docs = spark.createDataFrame([(i, x, "old") for i, x, _ in rows], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5], "doc_id bigint, toxic int")
    found = t.scored(docs, t.fit(docs, labels)).where("doc_id % 5 = 0").collect()
    truth = {i: y for i, _, y in rows}
    right = [r.predicted == truth[r.doc_id] for r in found]
    assert len(found) == 180 and sum(right) / len(right) > 0.95
    hits = [r.text[s.start : s.end].lower() for r in found if truth[r.doc_id] for s in r.spans]
    assert hits and sum("blarg" in h or "zwonk" in h or "qux" in h for h in hits) / len(hits) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)


def test_edges(spark):
    schema, kinds = "doc_id bigint, text string", "doc_id bigint, toxic int"
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "bad " * 3), (None, "x"), (4, "ok " * 30000), (4, " \n")], schema)
    labels = spark.createDataFrame([(3, 1), (3, 0), (2, 0), (None, 1), (1, None), (9, 1)], kinds)
    rows = t.scored(docs, t.fit(docs, labels)).collect()
    assert len(rows) == 6 and all(r.score is not None and 0 <= r.score <= 1 for r in rows)
    none = t.scored(docs, t.fit(docs, labels.limit(0))).collect()
    assert all(r.score < 1e-6 and r.predicted == 0 and r.spans == [] for r in none)
    assert t.scored(docs.limit(0), t.fit(docs.limit(0), labels)).count() == 0
