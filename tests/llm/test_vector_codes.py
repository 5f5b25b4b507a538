import hashlib
import random

import numpy as np
import pytest

from tracewright.llm import vector_codes as v

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, entries=256, rounds=4):
    """The same codes with plain integers and all distances."""
    kept = sorted((i, tuple(int(np.floor(1024 * float(np.float32(x)))) for x in e), n) for i, e, n in rows)
    width = len(kept[0][1]) // 4
    cut = [[e[p * width : (p + 1) * width] for _, e, _ in kept] for p in range(4)]
    books = [list(c[:entries]) for c in cut]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), k) for k, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            own = [nearest(x, books[p])[1] for x in cut[p]]
            for k in set(own):
                members = [x for x, o in zip(cut[p], own) if o == k]
                books[p][k] = tuple(sum(c) // len(members) for c in zip(*members))
    text = ",".join(str(x) for b in books for e in b for x in e)
    out, totals = {}, {}
    for r, (i, _, label) in enumerate(kept):
        found = [nearest(cut[p][r], books[p]) for p in range(4)]
        out[i] = ("".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label)
        totals[label] = totals.get(label, 0) + out[i][1]
    sha = hashlib.sha256(text.encode()).hexdigest()
    return {i: (c, e, totals[n], sha) for i, (c, e, n) in out.items()}


def collected(frame):
    return {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in frame.collect()}


@pytest.mark.parametrize("count, entries", [(300, 256), (120, 16), (5, 256)])
def test_against_all_distances(spark, count, entries):
    rng = random.Random(count)
    centers = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(6)]
    rows = []
    for i in range(count):
        center = rng.choice(centers)
        vector = [round(c + rng.gauss(0, 0.2), rng.choice((1, 3))) for c in center]
        rows.append((i * 7, vector, rng.choice((None, 1, 2))))
    rows += [(10_000 + i, list(rows[0][1]), 5) for i in range(40)]  # copies, a hot vector
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert collected(v.coded(frame, entries=entries)) == brute(rows, entries)


def test_search_equals_all_distances_with_ties():
    rng = np.random.default_rng(3)
    for high in (2, 5, 4000):
        entries = rng.integers(-high, high, (200, 3))
        rows = rng.integers(-high, high, (3000, 3))
        entry, far = v.Book(entries).nearest(rows)
        every = ((rows[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert (entry == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()
    entry, far = v.Book(np.zeros((1, 2), dtype=np.int64)).nearest(np.array([[3, 4]]))
    assert (entry.tolist(), far.tolist()) == ([0], [25])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5] * 8, 1), (1, [0.5] * 8, 1), (2, [-0.25] * 8, None), (3, None, 1), (4, [], 1), (5, [nan] * 8, 1),
            (6, [inf] * 8, 1), (7, [1.0, None] * 4, 1), (8, [1.0] * 12, 1), (9, [3e38] * 8, 1), (10, [1.0] * 6, 1),
            (None, [0.75] * 8, None)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as code", "2 as error", "3 as node")
    found = v.coded(frame)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    got = sorted((r.vec_id or 0, r.code) for r in found.collect())
    # The row without an id moves the first entry, so the second serves the copies.
    assert got == [(0, "00000000"), (1, "01010101"), (1, "01010101"), (2, "02020202")]
    assert v.coded(frame.limit(0)).count() == 0 and v.coded(frame.where("vec_id = 3")).count() == 0
    # Without any id the smallest vectors start the entries.
    assert [r.error for r in v.coded(frame.where("vec_id is null")).collect()] == [0]
