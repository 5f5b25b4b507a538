"""BPE encoding and decoding by a segment tree over the ranks of adjacent pairs.

The leaves of the tree are the positions of a word's symbols; a leaf holds the
rank of the pair that starts there. The root holds the lowest rank, the leftmost
one of equals. A merge changes three leaves, each an update of logarithmic cost,
until no pair can be merged. Words of up to 64 symbols are merged in batches
(one tree per row of a matrix), longer ones one at a time.

The vocabulary is that of a tokenizer file of the ``tokenizers`` library with
NFC, white space and lower-case normalisation, splitting by a pattern, byte-level
symbols and word ends. It is read on the driver and broadcast; its size is a
property of the file and is checked.

Defined results: a null text is empty; an empty text has no tokens and decodes to
the empty text. Special tokens in a text become their ids. Words of any length
are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from .common import whole_text

NONE = np.int64(1) << 62
BATCH_SYMBOLS = 64
CACHED_WORDS = 200_000
VOCABULARY_BYTES = 64 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def read_vocabulary(path: str) -> dict:
    """The parsed tokenizer file: plain values that a broadcast can carry."""
    text = Path(path).read_text(encoding="utf-8")
    if len(text) > VOCABULARY_BYTES:
        raise ValueError("the vocabulary is too large to broadcast")
    return json.loads(text)


class Vocabulary:
    """Ids, merge table, pattern and special tokens of a parsed tokenizer file."""

    def __init__(self, parsed: dict) -> None:
        model = parsed["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        self.pattern = parsed["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        pairs = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in model["merges"]]
        left, right, merged = (np.array(c, dtype=np.int64) for c in zip(*pairs))
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.key_ranks, self.merged = keys[order], order.astype(np.int64), merged
        self.first = np.array([self.ids[s] for s in byte_symbols()], dtype=np.int64)
        self.last = np.array([self.ids[s + self.end] for s in byte_symbols()], dtype=np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE if it cannot be merged."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (left >= 0) & (right >= 0), self.key_ranks[at], NONE)

    def symbols(self, word: bytes) -> np.ndarray:
        out = self.first[np.frombuffer(word, dtype=np.uint8)]
        out[-1] = self.last[word[-1]]
        return out


def merge_one(vocabulary: Vocabulary, symbols: np.ndarray) -> list[int]:
    """Merge one word of any length."""
    count = len(symbols)
    width = 1 << max(0, count - 1).bit_length()
    table = dict(zip(vocabulary.keys.tolist(), vocabulary.key_ranks.tolist()))
    merged = vocabulary.merged
    ids = symbols.tolist()
    after, before = list(range(1, count + 1)), list(range(-1, count - 1))
    none = int(NONE)
    tree = [none] * (2 * width)
    ranks = vocabulary.ranks(symbols[:-1], symbols[1:])
    leaves = np.where(ranks < NONE, ranks * width + np.arange(count - 1), NONE)
    tree[width : width + count - 1] = leaves.tolist()
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(place: int, rank: int | None) -> None:
        node = width + place
        tree[node] = none if rank is None else rank * width + place
        while node > 1:
            node >>= 1
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

    while tree[1] < none:
        rank, place = divmod(tree[1], width)
        gone = after[place]
        ids[place], ids[gone] = int(merged[rank]), -1
        after[place] = after[gone]
        put(gone, None)
        if after[place] < count:
            before[after[place]] = place
            put(place, table.get(ids[place] << 32 | ids[after[place]]))
        else:
            put(place, None)
        if (left := before[place]) >= 0:
            put(left, table.get(ids[left] << 32 | ids[place]))
    return [i for i in ids if i >= 0]


def merge_batch(vocabulary: Vocabulary, words: list[np.ndarray], width: int) -> list[list[int]]:
    """Merge words of at most ``width`` symbols, all trees in one matrix."""
    rows = len(words)
    ids = np.full((rows, width + 1), -1, dtype=np.int64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=rows)
    place = np.arange(width + 1)
    ids[place[None, :] < sizes[:, None]] = np.concatenate(words)
    after = np.broadcast_to(np.minimum(place + 1, width), ids.shape).copy()
    before = np.broadcast_to(place - 1, ids.shape).copy()
    tree = np.full((rows, 2 * width), NONE, dtype=np.int64)
    ranks = vocabulary.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(rows, width)
    tree[:, width:] = np.where(ranks < NONE, ranks * width + place[:width], NONE)
    level = width
    while level > 1:
        half = level // 2
        tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level = half

    def put(row: np.ndarray, at: np.ndarray, rank: np.ndarray) -> None:
        node = at + width
        tree[row, node] = np.where(rank < NONE, rank * width + at, NONE)
        while node[0] > 1:  # all leaves have the same depth
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    row = np.flatnonzero(tree[:, 1] < NONE)
    while len(row):
        rank, at = np.divmod(tree[row, 1], width)
        gone = after[row, at]
        ids[row, at] = vocabulary.merged[rank]
        ids[row, gone] = -1
        follow = after[row, gone]
        after[row, at] = follow
        before[row, follow] = at
        put(row, gone, np.full(len(row), NONE))
        put(row, at, vocabulary.ranks(ids[row, at], ids[row, follow]))
        left = before[row, at]
        has = left >= 0
        if has.any():
            put(row[has], left[has], vocabulary.ranks(ids[row[has], left[has]], ids[row[has], at[has]]))
        row = row[tree[row, 1] < NONE]
    kept = ids[:, :width]
    flat, cuts = kept[kept >= 0].tolist(), np.cumsum((kept >= 0).sum(axis=1)).tolist()
    return [flat[a:b] for a, b in zip([0, *cuts], cuts)]


class Encoder:
    """Encodes texts; remembers a bounded number of words."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.words = regex.compile(vocabulary.pattern)
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.normal_rare = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str
        self.split_rare = pre_tokenizers.Split(
            Regex(vocabulary.pattern), "removed", invert=True
        ).pre_tokenize_str
        self.ids: dict[str, str] = {}
        self.shown: dict[str, str] = {}
        for token, number in vocabulary.special.items():
            self._learn(token, [number])

    def _learn(self, word: str, ids: list[int]) -> None:
        self.ids[word] = " ".join(map(str, ids))
        self.shown[word] = " ".join(self.vocabulary.tokens[i] for i in ids)

    def _plain(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if any(unicodedata.category(c) == "Cn" for c in set(text)):
                # Characters on which the versions of Unicode in use may differ: ask the library.
                return [word for word, _ in self.split_rare(self.normal_rare(text))]
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # The library lower-cases each character alone: no final sigma.
        return self.words.findall(text.replace("Σ", "σ").lower())

    def split(self, text: str) -> list[str]:
        """The words of a text, special tokens among them."""
        if self.special is None or "<" not in text:
            return self._plain(text)
        out, start = [], 0
        for found in self.special.finditer(text):
            out += self._plain(text[start : found.start()])
            out.append(found.group())
            start = found.end()
        return out + self._plain(text[start:])

    def learn(self, words: set[str]) -> None:
        """Encode the words not known yet."""
        vocabulary, by_width = self.vocabulary, {}
        if len(self.ids) > CACHED_WORDS:
            special = {t: [i] for t, i in vocabulary.special.items()}
            self.ids, self.shown = {}, {}
            for token, ids in special.items():
                self._learn(token, ids)
        for word in words.difference(self.ids):
            symbols = vocabulary.symbols(word.encode("utf-8"))
            width = 2 << max(0, len(symbols) - 1).bit_length() - 1 if len(symbols) > 1 else 2
            by_width.setdefault(width, []).append((word, symbols))
        for width, found in by_width.items():
            lists = [s for _, s in found]
            if width > BATCH_SYMBOLS:
                merged = [merge_one(vocabulary, s) for s in lists]
            else:
                merged = merge_batch(vocabulary, lists, width)
            for (word, _), ids in zip(found, merged):
                self._learn(word, ids)

    def encoded(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """Per text the ids and the decoded text, each joined by blanks."""
        split = [self.split(t) for t in texts]
        self.learn(set().union(*split))
        for words in split:
            yield " ".join(map(self.ids.__getitem__, words)), " ".join(map(self.shown.__getitem__, words))


def encoded(docs: DataFrame, vocabulary_path: str, text_col: str = "text") -> DataFrame:
    """Add token_ids (decimal, one blank between), n_tokens and decoded to the documents.

    Columns of these names are replaced.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    @F.pandas_udf("token_ids string, n_tokens bigint, decoded string")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(Vocabulary(vocabulary.value))
        for texts in batches:
            found = [x for block in _blocks(texts) for x in encoder.encoded(block)]
            ids, shown = zip(*found) if found else ((), ())
            counts = [i.count(" ") + 1 if i else 0 for i in ids]
            yield pd.DataFrame({"token_ids": ids, "n_tokens": counts, "decoded": shown})

    return _with_result(docs, encode(whole_text(text_col)), ("token_ids", "n_tokens", "decoded"))


def digests(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc id, n_tokens, ids_sha256, decoded_sha256: hashed where the text is encoded."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(Vocabulary(vocabulary.value))

        def sha(text: str) -> str:
            return hashlib.sha256(text.encode("utf-8")).hexdigest()

        for texts in batches:
            rows = [
                (i.count(" ") + 1 if i else 0, sha(i), sha(d))
                for block in _blocks(texts)
                for i, d in encoder.encoded(block)
            ]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    names = ("n_tokens", "ids_sha256", "decoded_sha256")
    return _with_result(docs.select(id_col, text_col), digest(whole_text(text_col)), names).drop(text_col)


def _with_result(docs: DataFrame, result, names: tuple[str, ...]) -> DataFrame:
    found = docs.withColumn("_encoded", result)
    return found.withColumns({n: F.col(f"_encoded.{n}") for n in names}).drop("_encoded")


def _blocks(texts: pd.Series, characters: int = 2 << 20) -> Iterator[list[str]]:
    """Consecutive texts of about so many characters."""
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text)
        if size >= characters:
            yield block
            block, size = [], 0
    if block:
        yield block
