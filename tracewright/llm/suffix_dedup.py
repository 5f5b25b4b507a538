"""Passages of 50 or more bytes that an earlier document already holds.

A byte goes if a 50-byte string over it also starts in a document with a smaller
id. Documents travel in packed blocks. Every 50-byte window is routed by its least
hashed 16-byte gram, a function of the window alone, so equal windows of all
documents meet in one shard; runs of windows with the same gram are one segment.

1. Each block sends the hashes of its grams; what only one document has is not
   looked at again.
2. Segments of grams that several documents share go to their shard. There equal
   segments are one, with the least id that holds them; the suffixes that start at
   the windows are sorted by Larsson-Sadakane refinement (by 8 bytes first, then
   only the groups still tied, by the bytes behind, until depth 50); Kasai's rule
   gives the common prefixes of neighbours, and those of 50 or more join a group,
   which has the least id of its members. A shard of more than ``SHARD_WINDOWS``
   windows is cut into several suffix arrays, whose sorted distinct strings are
   merged by binary search. A gram whose distinct segments have more than
   ``HOT_WINDOWS`` windows is hot: its windows go by a hash of their own 50 bytes
   to other shards, so equal ones still meet.
3. The spans go back to their block.

Long documents are cut into overlapping slices; blocks have a fixed size, and what a
shard holds of the texts follows from the shards, as no gram brings more than
``HOT_WINDOWS``. The places of equal segments are not bounded (a few bytes each).

Defined results: null and empty texts, and texts under 50 bytes, lose nothing;
rows with a null id neither lose bytes nor make others lose any; rows that share
an id do not make each other lose bytes; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import pack, unpack

LENGTH, GRAM = 50, 16
# Bytes of text of a block, of a shard of segments, of a shard of gram hashes.
BLOCK_BYTES, SHARD_BYTES, GRAM_BYTES = 4 << 20, 12 << 20, 64 << 20
# Windows that one suffix array takes, and texts that one block takes.
SHARD_WINDOWS, BLOCK_ROWS = 8 << 20, 20_000
# Windows of the distinct segments of one gram beyond which it is hot, and shards of hot windows per shard.
HOT_WINDOWS, HOT_SHARDS = 1 << 20, 2
_U = np.uint64
C1, C2, C3 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0xFF51AFD7ED558CCD)


def grams8(data: np.ndarray, order: str = "<") -> np.ndarray:
    """The 8 bytes from each place as one number, without a copy."""
    return np.ndarray(max(0, len(data) - 7), dtype=f"{order}u8", buffer=data, strides=(1,))


def window_keys(data: np.ndarray) -> np.ndarray:
    """For each window of LENGTH bytes its least hashed gram."""
    eights = grams8(data).astype(np.uint64)
    hashed = eights[: len(data) - GRAM + 1] * C1
    hashed ^= hashed >> _U(29)
    hashed += eights[GRAM - 8 :] * C2
    hashed ^= hashed >> _U(32)
    hashed *= C3
    span, least = 1, hashed
    wanted = LENGTH - GRAM + 1
    while 2 * span <= wanted:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wanted:
        least = np.minimum(least[: len(hashed) - wanted + 1], least[wanted - span :][: len(hashed) - wanted + 1])
    return least


def segment_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Polynomial hashes of slices, modulo 2^64, from prefix sums."""
    factor = 0x5851F42D4C957F2D
    powers = np.cumprod(np.full(len(data), factor, dtype=np.uint64))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((data.astype(np.uint64) + _U(1)) * powers)])
    inverse = np.cumprod(np.full(len(data), pow(factor, -1, 1 << 64), dtype=np.uint64))
    slope = (sums[starts + sizes] - sums[starts]) * inverse[starts]
    return (slope ^ (sizes.astype(np.uint64) * C2)) * C3


def gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices one after the other."""
    ends = np.cumsum(sizes)
    index = np.repeat((starts - (ends - sizes)).astype(np.int32), sizes)
    index += np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int32)
    return data[index]


def slices(ids: list[int | None], texts: list[str | None], most: int) -> Iterator[list[tuple]]:
    """Lists of (id, row, offset, bytes); long texts overlap by LENGTH - 1 bytes."""
    out, size = [], 0
    for row, (doc, text) in enumerate(zip(ids, texts)):
        raw = text.encode("utf-8") if text and doc is not None else b""
        for start in range(0, len(raw) - LENGTH + 1, most):
            part = raw[start : start + most + LENGTH - 1]
            out.append((doc, row, start, part))
            size += len(part)
            if size >= most:
                yield out
                out, size = [], 0
    if out:
        yield out


class Segments:
    """Runs of windows with the same least gram, of one slice."""

    def __init__(self, parts: list[tuple]) -> None:
        self.ids, self.rows, self.offsets = (np.array([p[i] for p in parts], dtype=np.int64) for i in range(3))
        sizes = np.array([len(p[3]) for p in parts], dtype=np.int64)
        self.data = np.frombuffer(b"".join(p[3] for p in parts), dtype=np.uint8)
        self.first = np.cumsum(sizes) - sizes
        keys = window_keys(self.data)
        change = np.empty(len(keys), dtype=bool)
        change[0] = True
        np.not_equal(keys[1:], keys[:-1], out=change[1:])
        change[self.first] = True
        tails = self.first + sizes - LENGTH + 1
        change[tails[tails < len(keys)]] = True
        starts = np.flatnonzero(change)
        counts = np.diff(np.append(starts, len(keys)))
        part = np.searchsorted(self.first, starts, side="right") - 1
        good = starts < tails[part]
        self.starts, self.counts, self.part = starts[good], counts[good], part[good]
        self.keys = keys[self.starts] * C1

    def split(self, hot: np.ndarray, shards: int) -> tuple[np.ndarray, ...]:
        """Starts, counts, slices and shards of runs of windows, from segments of hot grams: a window's
        shard is a function of its bytes."""
        counts = self.counts[hot]
        ends = np.cumsum(counts)
        windows = np.repeat(self.starts[hot] - (ends - counts), counts)
        windows += np.arange(len(windows))
        hashed = segment_hashes(self.data, windows, np.full(len(windows), LENGTH))
        shard = shards + ((hashed >> _U(33)) % _U(HOT_SHARDS * shards)).astype(np.int64)
        new = np.append(True, shard[1:] != shard[:-1])
        new[(ends - counts)] = True
        at = np.flatnonzero(new)
        return windows[at], np.diff(np.append(at, len(windows))), np.repeat(self.part[hot], counts)[at], shard[at]

    def packed(self, shards: int, wanted: np.ndarray, hot: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(shard, packed segments) of the wanted ones, of the hot ones by window. Of equal ones only those
        of the least id have text."""
        starts, counts, part = self.starts[wanted], self.counts[wanted], self.part[wanted]
        shard = ((self.keys[wanted] >> _U(33)) % _U(shards)).astype(np.int64)
        if len(hot):
            both = zip((starts, counts, part, shard), self.split(hot, shards))
            starts, counts, part, shard = map(np.concatenate, both)
        if not len(starts):
            return
        lengths = counts + (LENGTH - 1)
        hashed = segment_hashes(self.data, starts, lengths)
        order = np.lexsort((self.ids[part], hashed))
        new = np.append(True, hashed[order][1:] != hashed[order][:-1])
        least = np.empty(len(order), dtype=np.int64)
        least[order] = self.ids[part][order[new]][np.cumsum(new) - 1]
        later = self.ids[part] > least
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.append(True, shard[order][1:] != shard[order][:-1]))
        for a, b in zip(cuts, np.append(cuts[1:], len(order))):
            of = order[a:b]
            used = np.unique(part[of])
            sent = of[~later[of]]
            yield int(shard[of[0]]), pack(
                self.ids[used], self.rows[used].astype(np.uint32), self.first[used].astype(np.uint32),
                self.offsets[used] - self.first[used], np.diff(starts[of], prepend=0).astype(np.uint32),
                counts[of].astype(np.uint32), np.packbits(later[of]),
                gathered(self.data, starts[sent], lengths[sent]),
            )


def gram_sets(found: list[Segments], shards: int) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Per shard the distinct gram hashes (40 bits, sorted) of a block and whether several ids have them;
    per slice the place of each segment's gram among all of the block, shard after shard."""
    keys = np.concatenate([f.keys for f in found]) if found else np.empty(0, dtype=np.uint64)
    ids = np.concatenate([f.ids[f.part] for f in found]) if found else np.empty(0, dtype=np.int64)
    value = ((keys >> _U(33)) % _U(shards)) << _U(40) | (keys & _U((1 << 40) - 1))
    names, place = np.unique(value, return_inverse=True)
    several = np.zeros(len(names), dtype=bool)
    owner = np.empty(len(names), dtype=np.int64)
    owner[place] = ids
    several[place[owner[place] != ids]] = True
    ends = np.searchsorted(names >> _U(40), np.arange(shards + 1, dtype=np.uint64))
    cuts = np.cumsum([len(f.keys) for f in found])[:-1]
    return ([names[a:b] & _U((1 << 40) - 1) for a, b in zip(ends, ends[1:])],
            [several[a:b] for a, b in zip(ends, ends[1:])], np.split(place, cuts) if found else [])


def distinct_windows(found: list[Segments], places: list[np.ndarray], names: list[np.ndarray]) -> list[np.ndarray]:
    """Per shard the windows that the distinct segments of each gram of a block have."""
    cuts = np.cumsum([len(n) for n in names])
    if not found:
        return np.split(np.empty(0, dtype=np.uint32), cuts[:-1])
    hashes = np.concatenate([segment_hashes(f.data, f.starts, f.counts + (LENGTH - 1)) for f in found])
    one = np.unique(hashes, return_index=True)[1]
    counts = np.concatenate([f.counts for f in found])[one]
    sums = np.bincount(np.concatenate(places)[one], counts, cuts[-1])
    return np.split(sums.astype(np.uint32), cuts[:-1])


def shared_grams(blobs: list[bytes], most: int = HOT_WINDOWS) -> tuple[list[bytes], list[bytes]]:
    """For each block's grams the bits that say whether several documents have them, and whether they are hot."""
    parts, flags, windows = [], [], []
    for blob in blobs:
        raw, several, counts = unpack(blob, "u1", "u1", "u4")
        windows.append(counts)
        wide = np.zeros((len(raw) // 5, 8), dtype=np.uint8)
        wide[:, :5] = raw.reshape(-1, 5)
        parts.append(wide.view(np.uint64).ravel())
        flags.append(np.unpackbits(several, count=len(raw) // 5).astype(bool))
    names, place, number = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    shared = number > 1
    shared[place[np.concatenate(flags)]] = True
    hot = np.bincount(place, np.concatenate(windows), len(names)) > most
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    return tuple([np.packbits(f).tobytes() for f in np.split(bits[place], cuts)] for bits in (shared, hot))


def refined(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the places to depth LENGTH, and which neighbours may agree that far.

    Larsson-Sadakane: a group of suffixes equal to depth h is sorted by what
    follows; suffixes alone in their group are at their final place.
    """
    eights = grams8(data, ">")
    keys = eights[places].astype(np.uint64)
    order = np.argsort(keys)
    keys = keys[order]
    tied = np.append(False, keys[1:] == keys[:-1])
    for depth in (8, 16, 24, 32, 40, LENGTH - 8):
        member = tied | np.append(tied[1:], False)
        at = np.flatnonzero(member)
        if not len(at):
            break
        group = np.cumsum(~tied[at])
        keys = eights[places[order[at]] + depth].astype(np.uint64)
        by_key = np.argsort(keys)
        rank = np.empty(len(at), dtype=np.int64)
        rank[by_key] = np.arange(len(at))
        by_group = np.argsort(group << 32 | rank)
        keys = keys[by_group]
        order[at] = order[at][by_group]
        tied[at] &= np.append(False, keys[1:] == keys[:-1])
    return order, tied


def common_prefixes(data: np.ndarray, left: np.ndarray, right: np.ndarray, cap: int = LENGTH) -> np.ndarray:
    """Common prefix, at most cap, of each pair of suffixes, by Kasai's rule.

    One byte on, the prefix is at most one shorter, if the neighbour moves on
    with the suffix: runs of consecutive ``left`` places start from what the
    place before found. Runs of at most 32 places advance side by side, eight bytes a
    comparison.
    """
    eights = grams8(data)
    out = np.zeros(len(left), dtype=np.int64)
    order = np.argsort(left)
    left, right = left[order], right[order]
    new = np.append(True, np.diff(left) != 1) | (left % 32 == 0) if len(left) else np.empty(0, dtype=bool)
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(left)))
    known, step = np.zeros(len(first), dtype=np.int64), 0
    while len(first):
        item = first + step
        moved = right[item] == right[np.maximum(item - 1, 0)] + 1
        have = np.where(moved & (step > 0), np.clip(known - 1, 0, cap - 8), 0)
        going = np.arange(len(item))
        while len(going):
            a = eights[left[item[going]] + have[going]]
            differ = a.astype(np.uint64) ^ eights[right[item[going]] + have[going]].astype(np.uint64)
            low = (differ & (~differ + _U(1))).astype(np.float64)
            equal = np.where(differ == 0, 8, np.floor((np.log2(np.maximum(low, 1)) + 0.5) / 8))
            have[going] += equal.astype(np.int64)
            going = going[(differ == 0) & (have[going] < cap)]
            # The last comparison looks back so that it stays inside the strings.
            have[going] = np.minimum(have[going], cap - 8)
        out[order[item]] = have
        step += 1
        more = size > step
        first, size, known = first[more], size[more], have[more]
    return out


def suffix_groups(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the places and the number of the group of equal strings, in that order."""
    order, tied = refined(data, places)
    at = np.flatnonzero(tied)
    prefix = common_prefixes(data, places[order[at]], places[order[at - 1]])
    joined = np.zeros(len(places), dtype=bool)
    joined[at] = prefix >= LENGTH
    return order, np.cumsum(~joined) - 1


def strings(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The LENGTH bytes from each place, as values that sort."""
    view = np.ndarray((len(data) - LENGTH + 1,), dtype=f"S{LENGTH}", buffer=data, strides=(1,))
    return view[places]


def merged(left: tuple, right: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted lists of distinct strings with least ids as one, by binary search."""
    (names, ids), (others, other_ids) = left, right
    at = np.searchsorted(others, names)
    inside = np.minimum(at, len(others) - 1)
    same = others[inside] == names
    other_ids = other_ids.copy()
    other_ids[inside[same]] = np.minimum(other_ids[inside[same]], ids[same])
    new = ~same
    return np.insert(others, at[new], names[new]), np.insert(other_ids, at[new], ids[new])


def least_ids(data: np.ndarray, places: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Per place the least id among the places with an equal string."""
    found, lists = np.empty(len(places), dtype=np.int64), []
    cuts = range(0, len(places), most)
    for start in cuts:
        part, owner = places[start : start + most], ids[start : start + most]
        order, group = suffix_groups(data, part)
        least = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, group, owner[order])
        out = np.empty(len(part), dtype=np.int64)
        out[order] = least[group]
        found[start : start + most] = out
        if len(cuts) > 1:
            head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            lists.append((strings(data, part[order[head]]), least))
    if len(lists) > 1:
        while len(lists) > 1:
            lists = [merged(*lists[i : i + 2]) if i + 1 < len(lists) else lists[i] for i in range(0, len(lists), 2)]
        names, least = lists[0]
        for start in cuts:
            part = strings(data, places[start : start + most])
            found[start : start + most] = least[np.searchsorted(names, part)]
    return found


KINDS = ("i8", "u4", "u4", "i8", "u4", "u4", "u1", "u1")


def spans_of(blocks: list[int], blobs: list[bytes], most: int = SHARD_WINDOWS) -> tuple[np.ndarray, ...]:
    """(block, row, start, length) of what goes, from the segments of one shard."""
    out, parts, base = [], [], 0
    for block, blob in zip(blocks, blobs):
        ids, rows, first, shift, steps, count, late, text = unpack(blob, *KINDS)
        start = np.cumsum(steps, dtype=np.int64)
        part = np.searchsorted(first, start, side="right") - 1
        count = count.astype(np.int64)
        later = np.unpackbits(late, count=len(start)).astype(bool)
        own = (np.full(len(start), block), rows[part].astype(np.int64), start + shift[part])
        out.append((*[c[later] for c in own], count[later] + LENGTH - 1))
        size = count[~later] + LENGTH - 1
        begin = np.cumsum(size) - size
        hashed = segment_hashes(text, begin, size) if len(size) else np.empty(0, dtype=np.uint64)
        parts.append((*[c[~later] for c in (ids[part], *own, count)], hashed, begin + base, text))
        base += len(text)
    docs, home, rows_, places, counts, hashes, begin, data = map(np.concatenate, zip(*parts))
    if not len(docs):
        return tuple(map(np.concatenate, zip(*out)))
    # One segment of each kind, of the least id.
    order = np.lexsort((docs, hashes))
    head = np.append(True, hashes[order][1:] != hashes[order][:-1])
    rank = np.cumsum(head) - 1
    one = order[head]
    least = np.empty(len(order), dtype=np.int64)
    least[order] = docs[one][rank]
    kind = np.empty(len(order), dtype=np.int64)
    kind[order] = rank
    gone = docs > least
    out.append((home[gone], rows_[gone], places[gone], counts[gone] + LENGTH - 1))
    windows = np.repeat(begin[one] - (np.cumsum(counts[one]) - counts[one]), counts[one])
    windows += np.arange(len(windows))
    owner = np.repeat(docs[one], counts[one])
    hit = least_ids(data, windows, owner, most) < owner
    # Runs of hits inside each kind of segment, for every row that has the least id.
    edge = np.zeros(len(hit) + 1, dtype=bool)
    first = np.cumsum(counts[one]) - counts[one]
    edge[first] = True
    starts = np.flatnonzero(hit & (edge[:-1] | ~np.append(False, hit[:-1])))
    ends = np.flatnonzero(hit & (np.append(edge[1:-1], True) | ~np.append(hit[1:], False))) + 1
    of_kind = np.searchsorted(first, starts, side="right") - 1
    rows = np.flatnonzero(~gone)
    rows = rows[np.argsort(kind[rows], kind="stable")]
    low = np.searchsorted(kind[rows], of_kind, side="left")
    many = np.searchsorted(kind[rows], of_kind, side="right") - low
    run = np.repeat(np.arange(len(starts)), many)
    row = rows[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(len(run))]
    out.append((home[row], rows_[row], places[row] + (starts - first[of_kind])[run],
                (ends - starts)[run] + LENGTH - 1))
    return tuple(map(np.concatenate, zip(*out)))


def covered(starts: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the covered bytes."""
    order = np.argsort(starts)
    starts, ends = starts[order], np.maximum.accumulate((starts + lengths)[order])
    new = np.append(True, starts[1:] > ends[:-1])
    return list(zip(starts[new].tolist(), ends[np.append(new[1:], True)].tolist()))


def packed_blocks(batches: Iterator[pa.RecordBatch], text_col: str, most: int) -> Iterator[pa.RecordBatch]:
    """(block, body): consecutive rows as one compressed Arrow stream, named by its content."""

    def closed(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows[0].schema) as stream:
            for batch in rows:
                stream.write_batch(batch)
        raw = sink.getvalue().to_pybytes()
        body = zstandard.ZstdCompressor(level=3).compress(raw)
        name = np.array([xxhash.xxh3_64_intdigest(raw)], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(name), pa.array([body], pa.binary())], ["block", "body"])

    held, size, rows = [], 0, 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[text_col]), 0).to_numpy(zero_copy_only=False)
        cut = 0
        for i, n in enumerate(sizes.tolist(), 1):
            size, rows = size + n, rows + 1
            if size >= most or rows >= BLOCK_ROWS:
                yield closed([*held, batch.slice(cut, i - cut)])
                held, size, rows, cut = [], 0, 0, i
        if cut < batch.num_rows:
            held.append(batch.slice(cut))
    if held:
        yield closed(held)


def opened(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(body)).read_all()


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
    shard_windows: int = SHARD_WINDOWS,
    block_bytes: int = BLOCK_BYTES,
    decode: bool = False,
    hot_windows: int = HOT_WINDOWS,
) -> DataFrame:
    """The documents with n_bytes, n_removed, n_spans, and kept: the bytes that stay.

    decode: kept is text, without characters that were cut in part. Columns of
    these names are replaced. The plan uses the exchange of the packed blocks three
    times; Spark runs it once.
    """
    docs = docs.drop(*[c for c in ("n_bytes", "n_removed", "n_spans", "kept") if c not in (id_col, text_col)])
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    gram_shards = max(1, -(-total // GRAM_BYTES))

    def segments_of(body: bytes) -> list[Segments]:
        table = opened(body)
        return [Segments(p) for p in slices(table[id_col].to_pylist(), table[text_col].to_pylist(), block_bytes)]

    def send_grams(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        # Equal blocks have one name and the same ids: one of them is enough.
        found = segments_of(part["body"].iloc[0])
        names, several, places = gram_sets(found, gram_shards)
        windows = distinct_windows(found, places, names)
        for shard, (values, flags, counts) in enumerate(zip(names, several, windows)):
            raw = values.view(np.uint8).reshape(-1, 8)[:, :5].ravel()
            if len(raw):
                out.append((shard, part["block"].iloc[0], pack(raw, np.packbits(flags), counts)))
        return pd.DataFrame(out, columns=["shard", "block", "body"])

    def answer(part: pd.DataFrame) -> pd.DataFrame:
        bits, hot = shared_grams(part["body"].tolist(), hot_windows)
        return pd.DataFrame({"block": part["block"], "shard": part["shard"], "bits": bits, "hot": hot})

    def send_segments(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            found = segments_of(left["body"].iloc[0])
            names, _, places = gram_sets(found, gram_shards)
            shared, hot = (np.concatenate([
                np.unpackbits(np.frombuffer(bits[n], dtype=np.uint8), count=len(v)) if len(v) else np.empty(0, np.uint8)
                for n, v in enumerate(names)
            ]).astype(bool) for bits in (dict(zip(right["shard"].tolist(), right[c].tolist())) for c in ("bits", "hot")))
            for part, place in zip(found, places):
                whole, split = (np.flatnonzero(shared[place] & (hot[place] == h)) for h in (False, True))
                out += [(s, left["block"].iloc[0], b) for s, b in part.packed(shards, whole, split)]
        return pd.DataFrame(out, columns=["shard", "block", "body"])

    def match(part: pd.DataFrame) -> pd.DataFrame:
        blocks, rows, starts, lengths = spans_of(part["block"].tolist(), part["body"].tolist(), shard_windows)
        order = np.lexsort((starts, rows, blocks))
        blocks, rows, starts, lengths = (a[order] for a in (blocks, rows, starts, lengths))
        cuts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) if len(blocks) else []
        return pd.DataFrame(
            [(int(blocks[a]), pack(np.diff(rows[a:b], prepend=0).astype(np.uint32), starts[a:b], lengths[a:b]))
             for a, b in zip(cuts, np.append(cuts[1:], len(blocks)))],
            columns=["block", "spans"])

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        spans: dict[int, list] = {}
        for blob in right["spans"].to_pylist():
            steps, starts, lengths = unpack(blob, "u4", "i8", "i8")
            rows = np.cumsum(steps, dtype=np.int64)
            edges = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
            for a, b in zip(edges.tolist(), np.append(edges[1:], len(rows)).tolist()):
                spans.setdefault(int(rows[a]), []).append((starts[a:b], lengths[a:b]))
        return pa.concat_tables([_without(opened(b), spans, text_col, decode) for b in left["body"].to_pylist()])

    names = StructType(list(docs.schema.fields)).add("n_bytes", "long").add("n_removed", "long")
    names = names.add("n_spans", "long").add("kept", "string" if decode else "binary")
    packed = docs.mapInArrow(lambda b: packed_blocks(b, text_col, block_bytes), "block bigint, body binary")
    grams = packed.groupBy("block").applyInPandas(send_grams, "shard int, block bigint, body binary")
    answers = grams.groupBy("shard").applyInPandas(answer, "block bigint, shard int, bits binary, hot binary")
    segments = packed.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        send_segments, "shard int, block bigint, body binary")
    found = segments.groupBy("shard").applyInPandas(match, "block bigint, spans binary")
    return packed.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(cut, names)


def _without(table: pa.Table, spans: dict[int, list], text_col: str, decode: bool) -> pa.Table:
    """The rows of a block with what stays of their texts."""
    sizes, removed, runs, kept = [], [], [], []
    for row, text in enumerate(table[text_col].to_pylist()):
        raw = (text or "").encode("utf-8")
        gone = covered(*map(np.concatenate, zip(*spans[row]))) if row in spans else []
        sizes.append(len(raw))
        removed.append(sum(b - a for a, b in gone))
        runs.append(len(gone))
        ends = [0, *[b for _, b in gone]]
        rest = b"".join(raw[a:b] for a, b in zip(ends, [*[a for a, _ in gone], len(raw)]))
        kept.append(rest.decode("utf-8", "ignore") if decode else rest)
    for name, values, kind in (("n_bytes", sizes, pa.int64()), ("n_removed", removed, pa.int64()),
                               ("n_spans", runs, pa.int64()), ("kept", kept, pa.string() if decode else pa.binary())):
        table = table.append_column(name, pa.array(values, kind))
    return table


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with what stays as their text; a character cut in part goes."""
    kept = without_repeats(docs, id_col, text_col, decode=True, **options)
    text = F.when(F.col("n_removed") == 0, F.col(text_col)).otherwise(F.col("kept"))
    return kept.withColumn(text_col, text).select(docs.columns)


def repeats_sql(table: str = "documents", width: int = 50) -> str:
    """DuckDB SQL of what is removed, by all windows of all texts; for small tables."""
    return f"""
        WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM {table}),
        sized AS (SELECT *, length(h) // 2 AS n FROM docs),
        starts AS (SELECT doc_id, h, unnest(range(0, n - {width - 1})) AS i FROM sized WHERE n >= {width}),
        windows AS (SELECT doc_id, i, substr(h, 2 * i + 1, {2 * width}) AS g FROM starts),
        firsts AS (SELECT g, min(doc_id) AS first_doc FROM windows GROUP BY g HAVING min(doc_id) < max(doc_id)),
        hits AS (SELECT doc_id, i FROM windows JOIN firsts USING (g) WHERE first_doc < doc_id),
        marked AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER w + {width} THEN 1 ELSE 0 END AS new FROM hits
            WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        runs AS (SELECT doc_id, min(i) AS a, max(i) + {width} AS b FROM (
            SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked) GROUP BY doc_id, run),
        pieces AS (
            SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS low FROM runs
            UNION ALL SELECT s.doc_id, n, coalesce(max(b), 0) FROM sized s LEFT JOIN runs r ON r.doc_id = s.doc_id
                GROUP BY s.doc_id, n),
        kept AS (SELECT p.doc_id, string_agg(substr(h, 2 * low + 1, 2 * (a - low)), '' ORDER BY a) AS body
            FROM pieces p JOIN sized s ON s.doc_id = p.doc_id GROUP BY p.doc_id),
        sums AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
        SELECT s.doc_id, s.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
            sha256(unhex(coalesce(body, ''))) AS kept_sha256
        FROM sized s LEFT JOIN sums ON sums.doc_id = s.doc_id LEFT JOIN kept ON kept.doc_id = s.doc_id"""
