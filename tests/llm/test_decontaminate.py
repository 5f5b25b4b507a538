import random

import pytest

from tracewright.llm import decontaminate as d

ITEM = ("The quick brown fox jumps over the lazy dog while seven wizards brew a bitter potion of old "
        "roots and the moon climbs slowly above the quiet hills")


def distance_in(item, text):
    """Plain dynamic programming: least distance of the item to any part of the text."""
    last = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        row = [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
        last = row
    return min(last)


def edited(text, edits, rng):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("xyz")
        elif kind == 1:
            out.insert(at, rng.choice("xyz"))
        else:
            del out[at]
    return "".join(out)


@pytest.mark.parametrize("seed", range(40))
def test_myers_and_pigeonhole(seed):
    rng = random.Random(seed)
    text = "some words before " * rng.randrange(3) + edited(ITEM, seed % 16, rng) + " and after" * rng.randrange(3)
    item, data = d.normal(ITEM), d.normal(text)
    least = distance_in(item, data)
    assert d.myers(d.letter_masks(item), len(item), data)[0] == least
    found = d.Finder([(7, item)], 15)(text)
    assert [(i, e) for i, e, _ in found] == ([(7, least)] if least <= len(item) // 15 else [])


def test_frames(spark):
    docs = spark.createDataFrame([
        (1, f"intro {ITEM.upper()} outro", 0), (2, None, 0), (3, "", 0), (4, "nothing here", 0),
        (5, ITEM.replace("wizards", "lizards").replace(" ", "\n\t"), 0), (None, ITEM, 0),
        (6, "words " * 20000 + ITEM + " words" * 20000, 0), (6, ITEM, 0), (7, ITEM[: len(ITEM) // 2], 0),
    ], "doc_id bigint, text string, item_id int")
    items = spark.createDataFrame([(1, ITEM, 2), (2, None, 3), (3, "", 4), (4, "entirely different words", 5)],
                                  "item_id bigint, text string, errors int")
    rows = d.matches(docs, items, block_bytes=20).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.errors) for r in rows) == [
        (0, 1, 0), (1, 1, 0), (5, 1, 1), (6, 1, 0), (6, 1, 0)]
    kept = d.clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 7]
    assert d.matches(docs.limit(0), items).count() == 0 and d.clean(docs, items.limit(0)).count() == 9


@pytest.mark.parametrize("group_bytes", [1, 400, 1 << 20])
def test_large_benchmarks_take_several_passes(spark, group_bytes):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(500)]
    wanted = [(f"item {i}", " ".join(rng.choice(words) for _ in range(25))) for i in range(12)]
    texts = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(40)]
    held = {3: [0], 9: [11, 5], 17: [5], 30: [7]}
    for doc, found in held.items():
        texts[doc] += " " + " and ".join(wanted[i][1].upper() for i in found)
    docs = spark.createDataFrame([(f"doc {i}", t, "x") for i, t in enumerate(texts)], "doc_id string, text string, _found string")
    items = spark.createDataFrame(wanted, "item_id string, text string")
    options = {"block_bytes": 150, "group_bytes": group_bytes}
    rows = d.matches(docs, items, **options).collect()
    assert sorted((r.doc_id, r.item_id, r.errors) for r in rows) == sorted(
        (f"doc {k}", f"item {i}", 0) for k, v in held.items() for i in v)
    kept = d.clean(docs.drop("_found"), items, **options)
    assert {r.doc_id for r in kept.collect()} == {f"doc {i}" for i in range(40) if i not in held}
