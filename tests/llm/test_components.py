import random

import numpy as np
import pytest

from tracewright.llm.common import WordHashes, pack, partitions, staged, unpack
from tracewright.llm.components import components


def plain(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize("kind", ["random", "chain", "hub", "tangle"])
def test_components(spark, kind):
    rng = random.Random(kind)
    if kind == "random":
        edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    elif kind == "chain":
        names = rng.sample(range(1000), 120)
        edges = list(zip(names, names[1:]))
    elif kind == "hub":
        edges = [(77, i) for i in range(300)] + [(1000, 299), (1000, 1000)]
    else:
        edges = [(1, 2), (1, 2), (2, 1), (5, 5), (None, 3), (3, None), (9, 8), (8, 7), (-4, 9)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.component for r in found} == plain(edges)


@pytest.mark.parametrize("stars", [0, 300])
@pytest.mark.parametrize("path", [
    [1, 5, 6, 7, 2], [12, 21, 24, 39, 17], [18, 30, 23, 27, 19, 36], [11, 33, 20, 16, 2, 34, 27],
    [11, 21, 5, 23, 25, 35, 20, 24],
])
def test_short_path_is_one_component(spark, path, stars):
    """After a round some children have two parents, though no child is a parent."""
    edges = list(zip(path, path[1:])) + [(1000 + 4 * i, 1001 + 4 * i + j) for i in range(stars) for j in (0, 1)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()
    assert sorted((r.node, r.component) for r in found) == sorted(plain(edges).items())


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def test_packed_arrays():
    arrays = [np.arange(5, dtype=np.int64), np.empty(0, dtype=np.uint8), np.array([1.5], dtype=np.float32)]
    for a, b in zip(arrays, unpack(pack(*arrays), "i8", "u1", "f4")):
        assert a.dtype == b.dtype and (a == b).all()


def test_staged_rows_and_sizes(spark):
    rows = spark.range(10).selectExpr("id", "cast(null as string) as text")
    # Parquet keeps names and types; every column may hold nulls then.
    assert staged(rows, "x").dtypes == rows.dtypes and staged(rows.limit(0), "x").count() == 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert partitions(spark, 0, 10) == least and partitions(spark, 10_001, 10) == 1001


def test_word_hashes_are_kept():
    known = WordHashes()
    assert known[b"a"] == known[b"a"] != known[b"b"] and len(known) == 2
