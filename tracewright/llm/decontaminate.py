"""Benchmark items in documents, found with a budget of edits.

Text is compared as UTF-8 with A-Z lower-cased and runs of white space as one
blank. An item of m bytes may differ by k = m // ``bytes_per_edit`` edits. Cut
into k + 1 pieces, at least one of them occurs unchanged in every occurrence
(pigeonhole), so one automaton over all pieces finds the places to look at, and
Myers' bit-parallel distance decides there.

Items are broadcast in blocks of bounded size and looked for in the whole text, by up
to ``GROUP_BYTES`` of items in one pass over the documents. A larger benchmark takes
several passes, each written to the shared folder, so neither the driver nor a worker
ever holds more than one pass needs.

Defined results: null and empty texts match nothing; null and empty items are
skipped; repeated documents are reported one by one; of equal distances the
first place counts. Ids may be of any type that is kept as it is; an empty table of
documents or items gives no matches. Very long texts are looked through whole. Other
columns of the documents stay in ``clean``, whatever their names; ``matches`` names
its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, whole_text

BYTES_PER_EDIT = 15
# Items that one broadcast holds; an automaton takes about 40 times as much.
BLOCK_BYTES = 1 << 20
# Items that one pass over the documents looks for.
GROUP_BYTES = 8 << 20


def normal(text: str) -> bytes:
    return b" ".join(text.encode("utf-8").lower().split())


def pieces(item: bytes, budget: int) -> list[tuple[int, bytes]]:
    """budget + 1 pieces of near-equal length with their offsets."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def letter_masks(item: bytes) -> dict[int, int]:
    """Per byte value the positions of the item that hold it, as bits."""
    masks: dict[int, int] = {}
    for place, byte in enumerate(item):
        masks[byte] = masks.get(byte, 0) | 1 << place
    return masks


def myers(masks: dict[int, int], length: int, text: bytes) -> tuple[int, int]:
    """(least edit distance of the item to any part of the text, end of the first such part)."""
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    best, end = length, 0
    for place, byte in enumerate(text, 1):
        equal = masks.get(byte, 0)
        vertical = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(across | plus) & full
        down = plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best, end = score, place
        up, down = up << 1 & full, down << 1 & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
    return best, end


class Finder:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int | None, bytes]], bytes_per_edit: int) -> None:
        self.items = [(i, t, len(t) // bytes_per_edit, letter_masks(t)) for i, t in items]
        places: dict[bytes, list[tuple[int, int]]] = {}
        for number, (_, text, budget, _) in enumerate(self.items):
            for offset, piece in pieces(text, budget):
                places.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece.decode("latin-1"), (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.any = bool(places)

    def __call__(self, text: str) -> list[tuple[int | None, int, int]]:
        if not self.any:
            return []
        data = normal(text)
        windows: dict[int, list[list[int]]] = {}
        for end, (size, where) in self.automaton.iter(data.decode("latin-1")):
            for number, offset in where:
                _, item, budget, _ = self.items[number]
                begin = end + 1 - size - offset - budget
                stop = begin + len(item) + 2 * budget
                known = windows.setdefault(number, [])
                # Hits come by their ends, so those of one item nearly in order of place.
                if known and begin <= known[-1][1] and stop >= known[-1][0]:
                    known[-1] = [min(begin, known[-1][0]), max(stop, known[-1][1])]
                else:
                    known.append([begin, stop])
        found = []
        for number, spans in windows.items():
            item_id, item, budget, masks = self.items[number]
            best = min(
                ((e, max(0, a) + at) for a, b in spans
                 for e, at in [myers(masks, len(item), data[max(0, a) : b])]),
                default=(budget + 1, 0),
            )
            if best[0] <= budget:
                found.append((item_id, *best))
        return found


def _groups(
    items: DataFrame, id_col: str, text_col: str, block_bytes: int, group_bytes: int
) -> Iterator[list[list[tuple]]]:
    """Blocks of (id, text) in groups, each group of bounded size; at least one, maybe empty."""
    group, block, in_group, in_block = [], [], 0, 0
    rows = items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    for item, text in rows.orderBy("i", "t").toLocalIterator():
        data = normal(text or "")
        if not data:
            continue
        if block and in_block + len(data) > block_bytes:
            group.append(block)
            block, in_block = [], 0
        if group and in_group + len(data) > group_bytes:
            yield group
            group, in_group = [], 0
        block.append((item, data))
        in_block, in_group = in_block + len(data), in_group + len(data)
    if block:
        group.append(block)
    yield group


def _matches_of(blocks: list[list[tuple]], items: DataFrame, id_col: str, text: Column, bytes_per_edit: int) -> Column:
    """The items of the blocks that occur in a text, each with its least distance and where that ends."""
    context = items.sparkSession.sparkContext
    kind = items.schema[id_col].dataType.simpleString()
    schema = f"array<struct<item_id: {kind}, errors: int, ends_at: bigint>>"

    def column(block: list[tuple]) -> Column:
        held = context.broadcast(block)

        @F.pandas_udf(schema)
        def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            finder = Finder(held.value, bytes_per_edit)
            for texts in batches:
                yield pd.Series([
                    [{"item_id": i, "errors": e, "ends_at": at} for i, e, at in finder(t)] for t in texts
                ])

        return find(text)

    return F.concat(*[column(b) for b in blocks]) if blocks else F.array().cast(schema)


def matches(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text_col: str = "text",
    bytes_per_edit: int = BYTES_PER_EDIT, item_id: str = "item_id", item_text: str = "text",
    block_bytes: int = BLOCK_BYTES, group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """doc id, item_id, errors, ends_at (in the compared text): one row per document and item."""
    parts, last = [], None
    for blocks in _groups(items, item_id, item_text, block_bytes, group_bytes):
        if last is not None:
            parts.append(staged(last, "matches"))
        column = _matches_of(blocks, items, item_id, whole_text(text_col), bytes_per_edit)
        found = docs.select(F.col(doc_id).alias("_doc"), column.alias("_found"))
        last = found.select("_doc", F.inline("_found")).withColumnRenamed("_doc", doc_id)
    return reduce(DataFrame.unionByName, [*parts, last])


def clean(
    docs: DataFrame, items: DataFrame, text_col: str = "text", bytes_per_edit: int = BYTES_PER_EDIT,
    item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES, group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """The documents in which no item occurs."""
    columns, kept = docs.columns, None
    for blocks in _groups(items, item_id, item_text, block_bytes, group_bytes):
        rows = docs if kept is None else staged(kept, "without-items")
        column = _matches_of(blocks, items, item_id, whole_text(text_col), bytes_per_edit)
        kept = rows.withColumn("_found", column).where(F.size("_found") == 0).select(columns)
    return kept
