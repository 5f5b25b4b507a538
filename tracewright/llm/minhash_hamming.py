"""Near-duplicate documents: b-bit MinHash signatures and a multi-index Hamming join.

A signature has 40 symbols of 16 bits, cut into 8 chunks of 5. Two signatures at
a Hamming distance below 16 symbols have a chunk with at most one error
(pigeonhole), so each chunk is indexed once per place of that error, the symbol
there masked: 40 keys a document. All pairs below that distance, and most beyond,
share a key; a pair of similarity 0.8 misses all keys with probability 2e-5.
Candidates are confirmed on their full shingle sets.

Documents with equal sets are one node from the start. Within a key's members pairs
are not all formed. The eight plain chunks come first: each member is compared with
the least one of its chunk, which links most of a group of copies. Masked keys carry
the component found so far, and only those that hold several components are looked
looked at: first against the least member, then against the member that shares most, then
against members of other components, so links that could join two components are
never skipped and a group that is linked already adds no rows. The last step goes by
prefixes: in the order of their holders, two similar sets share one of the first fifth
of their shingles. If fewer than RARE_HOLDERS nodes hold that one, the pair is found by
it, which adds at most so many rows for each; else the two share none that is rarer, so
both have as many common shingles as the similarity needs, and only such members of
a key are paired. Pairs are dropped before the full comparison only if their sizes
exclude the similarity, if the shingles that each shares with any other member do
(at most those can be common), or if a sketch of 120 bits differs in over 36 bits
(probability 4.3e-6 at similarity 0.8) or one of 2048 bits in over 273 (6.2e-7).

Defined results: words are split at ASCII white space with A-Z lower-cased; fewer
words than a shingle form one shingle; null and empty texts have no shingles and
link with nothing; rows with a null id link with nothing and are kept; rows that
share an id are one node. Other columns of the table are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, staged_rows, whole_text
from .components import components
from .url_filter import LOWER, UPPER

SYMBOLS, CHUNK, SKETCH_BITS = 40, 5, 36
# Long sketches of one bit a hash, as so many 64-bit words, and the bits in which they may differ.
LONG_WORDS, LONG_BITS = 32, 273
# Hashes that are made at once, few enough for the processor's cache.
BLOCK_HASHES = 32_768
# A shingle with so many holders is common, one with fewer leads from each holder to the others.
RARE_HOLDERS = 100
# Ids up to this number are broadcast (8 bytes each), more are joined.
BROADCAST_IDS = 1_000_000
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _odd(count: int, seed: int) -> np.ndarray:
    """Fixed odd multipliers."""
    return np.random.default_rng(seed).integers(0, 1 << 63, count, dtype=np.uint64) * _U(2) + _U(1)


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted; on short arrays several times as fast as np.unique."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def shingle_set(text: str, width: int, factors: np.ndarray) -> np.ndarray:
    """The distinct hashed shingles of a text, sorted."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    # Hashing a word takes less than looking it up among many.
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    if len(words) < width:
        parts = hashes * factors[: len(words)]
        return _mixed(parts.sum(keepdims=True) + _U(len(words)))
    count = len(words) - width + 1
    total = np.zeros(count, dtype=np.uint64)
    for place in range(width):
        total += hashes[place : place + count] * factors[place]
    return _distinct(_mixed(total))


def minhashes(shingles: np.ndarray, seeds: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least hash of the set under each function, in blocks of functions and shingles."""
    best = np.full(len(seeds), np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), 4096):
        part = shingles[start : start + 4096]
        step = BLOCK_HASHES // len(part)
        for first in range(0, len(seeds), step):
            some = slice(first, first + step)
            hashes = part ^ seeds[some, None]
            hashes *= factors[some, None]
            best[some] = np.minimum(best[some], hashes.min(axis=1))
    return best


def signatures(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """node, n, set_a, set_b (equal for equal sets), sketch_a, sketch_b, symbols (16 bits each)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _odd(width, 1)
        seeds, factors = _odd(SYMBOLS, 2), _odd(SYMBOLS, 3)
        shifts = (np.arange(SYMBOLS // 2) * 3).astype(np.uint64)
        for batch in _parts(batches):
            out = []
            for node, text in zip(batch["node"], batch["text"]):
                found = shingle_set(text, width, words)
                if not len(found):
                    out.append((node, 0, 0, 0, 0, 0, b""))
                    continue
                low = _mixed(minhashes(found, seeds, factors))
                sketch = (low >> _U(40)) & _U(7)
                halves = [int((s << shifts).sum()) for s in (sketch[: SYMBOLS // 2], sketch[SYMBOLS // 2 :])]
                sums = [int(s) >> 1 for s in (found.sum(), _mixed(found ^ _U(0x5851F42D4C957F2D)).sum())]
                out.append((node, len(found), *sums, *halves, (low & _U(0xFFFF)).astype("<u2").tobytes()))
            yield pd.DataFrame(out, columns=["node", "n", "set_a", "set_b", "sketch_a", "sketch_b", "symbols"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("node"), whole_text(text_col).alias("text"))
    return rows.mapInPandas(
        run, "node bigint, n bigint, set_a bigint, set_b bigint, sketch_a bigint, sketch_b bigint, symbols binary")


CARRIED = ("component", "node", "n", "sketch_a", "sketch_b")


def chunk_keys(placed: DataFrame, masked: bool) -> DataFrame:
    """(key, component, node, n, sketch_a, sketch_b): each chunk of symbols, whole or with each place masked."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factors, chunks = _odd(SYMBOLS, 4), _odd(SYMBOLS // CHUNK, 7)
        for batch in batches:
            if not len(batch):
                continue
            symbols = np.frombuffer(b"".join(batch["symbols"]), dtype="<u2").reshape(len(batch), SYMBOLS)
            parts = (symbols.astype(np.uint64) + _U(1)) * factors
            sums = parts.reshape(len(batch), SYMBOLS // CHUNK, CHUNK).sum(axis=2, dtype=np.uint64)
            # The factor of the masked place also tells the chunk and the mask apart.
            keys = _mixed(np.repeat(sums, CHUNK, axis=1) - parts + factors * _U(0x9E3779B9)) if masked else _mixed(
                sums + chunks)
            yield pd.DataFrame({
                "key": keys.astype(np.int64).ravel(),
                **{c: np.repeat(batch[c].to_numpy(), keys.shape[1]) for c in CARRIED},
            })

    return placed.select(*CARRIED, "symbols").mapInPandas(
        run, "key bigint, " + ", ".join(f"{c} bigint" for c in CARRIED))


def _to_head(placed: DataFrame, masked: bool, percent: int) -> DataFrame:
    """Distinct pairs (a, b): members of a key with its least node, if that is of another component."""
    keyed = chunk_keys(placed, masked)
    heads = _split_keys(keyed).join(
        placed.select(*[F.col(c).alias("head" if c == "node" else f"_{c}") for c in CARRIED]), "head")
    near = _possible({c: F.col(c) for c in CARRIED}, {c: F.col(f"_{c}") for c in CARRIED}, percent)
    pairs = keyed.alias("k").join(
        heads.alias("h"), (F.col("k.key") == F.col("h.key")) & (F.col("component") != F.col("_component")) & near)
    return pairs.select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()


def _split_keys(keyed: DataFrame, more_than: int = 1) -> DataFrame:
    """(key, head): the keys that hold several components, with their least node."""
    return keyed.groupBy("key").agg(
        F.min("node").alias("head"), F.min("component").alias("low"), F.max("component").alias("high"),
        F.count("*").alias("members"),
    ).where((F.col("low") < F.col("high")) & (F.col("members") > more_than)).select("key", "head")


def _parts(batches: Iterator[pd.DataFrame], rows: int = 500) -> Iterator[pd.DataFrame]:
    """Few rows at a time, as what is made of a text may be larger than the text."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.iloc[start : start + rows].copy()


def _shingles_of(docs: DataFrame, nodes: DataFrame, number: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) of the nodes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _odd(width, 1)
        for batch in _parts(batches):
            sets = [shingle_set(t, width, words).astype(np.int64) for t in batch["text"]]
            yield pd.DataFrame({"node": batch["node"], "shingles": sets})

    rows = docs.select(F.col(id_col).cast("bigint").alias("node"), whole_text(text_col).alias("text"))
    wanted = F.broadcast(nodes) if number <= BROADCAST_IDS else nodes
    return rows.join(wanted, "node", "left_semi").mapInPandas(run, "node bigint, shingles array<bigint>")


def long_sketch(shingles: np.ndarray, seeds: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """One bit of each of 64 x LONG_WORDS minima."""
    bits = _mixed(minhashes(shingles, seeds, factors)) & _U(1)
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _possible(a: dict[str, Column], b: dict[str, Column], percent: int) -> Column:
    """Whether sizes and sketches of two members leave the similarity possible."""
    low, high = F.least(a["n"], b["n"]), F.greatest(a["n"], b["n"])
    bits = [F.bit_count(a[c].bitwiseXOR(b[c])) for c in ("sketch_a", "sketch_b")]
    return (low * 100 >= high * percent) & (bits[0] + bits[1] <= SKETCH_BITS)


def _shared_with_others(
    docs: DataFrame, rows: DataFrame, percent: int, width: int, id_col: str, text_col: str
) -> DataFrame:
    """(node, shared, common, prefix, long) of the nodes of the rows.

    shared: how many shingles of a node any other node has too; common: how many of them
    RARE_HOLDERS nodes have or more; prefix: the rarer ones by which it is found, as two similar
    sets share one of the first n - ceil(n * percent / 100) + 1 shingles in any order; long: its long sketch.
    """

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seeds, factors = _odd(64 * LONG_WORDS, 5), _odd(64 * LONG_WORDS, 6)
        for batch in _parts(batches):
            batch["long"] = [long_sketch(s.astype(np.int64).view(np.uint64), seeds, factors) for s in batch["shingles"]]
            yield batch

    nodes, number = staged_rows(rows.select("node").distinct(), "rest-nodes")
    sets = _shingles_of(docs, nodes, number, width, id_col, text_col)
    sets = staged(
        sets.dropDuplicates(["node"]).mapInPandas(
            sketched, "node bigint, shingles array<bigint>, long array<bigint>"), "rest-sets")
    held = sets.select("node", F.explode("shingles").alias("shingle"))
    holders = held.groupBy("shingle").agg(F.count("*").alias("holders"), F.min("node").alias("node"))
    alone = holders.where("holders = 1").groupBy("node").agg(F.count("*").alias("alone"))
    few = holders.where((F.col("holders") > 1) & (F.col("holders") < RARE_HOLDERS)).select("shingle", "holders")
    rare = held.join(few, "shingle").groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("holders", "shingle"))).alias("rare"))
    size = F.col("size")
    own = F.coalesce("alone", F.lit(0)).cast("int")
    many = F.coalesce(F.size("rare"), F.lit(0))
    first = size - F.ceil(size * percent / 100).cast("int") + 1 - own
    sized = sets.select("node", F.size("shingles").alias("size"), "long")
    found = sized.join(alone, "node", "left").join(rare, "node", "left").select(
        "node", (size - own).alias("shared"), (size - own - many).alias("common"),
        F.slice(F.col("rare")["shingle"], F.lit(1), F.greatest(first, F.lit(0))).alias("prefix"), "long")
    return staged(found, "shared")


def _confirmed(docs: DataFrame, pairs: DataFrame, percent: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    nodes, number = staged_rows(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "paired-nodes")
    sets = _shingles_of(docs, nodes, number, width, id_col, text_col)
    # Rows that share an id: one of their sets stands for the id.
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - shared
    return both.where(shared * 100 >= union * percent).select("a", "b")


def _unlinked(placed: DataFrame) -> tuple[DataFrame, int]:
    """Members of the masked keys that hold several components, and how many there are.

    Two members of a key have met already, as one of them is its head.
    """
    keyed = chunk_keys(placed, True)
    return staged_rows(keyed.join(_split_keys(keyed, 2), "key", "left_semi"), "split")


def _placed(nodes: DataFrame, reached: DataFrame | None) -> DataFrame:
    """The nodes with their component."""
    if reached is None:
        return nodes.withColumn("component", F.col("node"))
    return staged(
        nodes.join(reached, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")


def _merged(reached: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components by the links found so far and the new ones."""
    if reached is not None:
        links = reached.where("node <> component").select(
            F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)
    return components(links, "a", "b", written=True)


MEMBER = ("component", "node", "n", "shared", "sketch_a", "sketch_b", "long")


def _joined(left: DataFrame, right: DataFrame, by: str, most: str, percent: int) -> DataFrame:
    """Members of different components with the same value of a column that may be similar enough.

    most: the column that bounds what a member has in common with the other. The
    columns of the second member begin with a line.
    """
    other = right.select(by, *[F.col(c).alias(f"_{c}") for c in right.columns if c != by])
    both = F.least(most, f"_{most}")
    return left.join(other, by).where(
        (F.col("component") != F.col("_component"))
        & (both * 100 >= (F.col("n") + F.col("_n") - both) * percent)
        & _possible({c: F.col(c) for c in CARRIED}, {c: F.col(f"_{c}") for c in CARRIED}, percent))


def _alike() -> Column:
    """Whether the long sketches leave the similarity possible."""
    differ = F.zip_with("long", "_long", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(differ, F.lit(0), lambda bits, more: bits + more) <= LONG_BITS


def _ends(found: DataFrame) -> DataFrame:
    return found.select(F.greatest("node", "_node").alias("a"), F.least("node", "_node").alias("b")).distinct()


def _to_center(rest: DataFrame, percent: int) -> DataFrame:
    """Each member with the one of its key that shares most with the others."""
    order = F.struct((F.col("shared") / F.col("n")).alias("share"), "n", (-F.col("node")).alias("node"))
    centers = rest.groupBy("key").agg(F.max_by(F.struct(*MEMBER), order).alias("c")).select("key", "c.*")
    return _ends(_joined(rest.select("key", *MEMBER), centers, "key", "shared", percent).where(_alike()))


def _by_rare(rest: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components with a shingle of their prefixes in common."""
    members = rest.select(*CARRIED, "shared").distinct()
    held = members.join(shared.select("node", F.explode("prefix").alias("shingle")), "node")
    pairs = _ends(_joined(held, held, "shingle", "shared", percent).where(F.col("node") > F.col("_node")))
    for end, name in (("a", "long"), ("b", "_long")):
        pairs = pairs.join(shared.select(F.col("node").alias(end), F.col("long").alias(name)), end)
    return pairs.where(_alike()).select("a", "b")


def _by_common(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components of a key that may be similar by their common shingles alone.

    The members outside the largest component of their key (main) are joined with all others,
    if what they have in common is enough for the smallest member and if any has enough for them.
    A pair with several keys in common is formed for the least one only.
    """
    rest = rest.where(F.col("common") * 100 >= F.col("n") * percent)
    # The size of the other, times percent, up to which the common shingles suffice.
    reach = F.col("common") * (100 + percent) - F.col("n") * percent
    parts = rest.groupBy("key", "component").agg(
        F.count("*").alias("rows"), F.min("n").alias("least"), F.max(reach).alias("reach"))
    main = parts.groupBy("key").agg(
        F.max_by("component", F.struct("rows", "component")).alias("main"), F.count("*").alias("parts"),
        F.min("least").alias("least"), F.max("reach").alias("most"))
    # At most SYMBOLS keys a node.
    keys = rest.groupBy("node").agg(F.collect_set("key").alias("keys"))
    known = rest.join(keys, "node").select("key", "keys", *MEMBER, "common")
    outside = rest.join(main.where("parts > 1"), "key").where(
        (F.col("component") != F.col("main")) & (reach >= F.col("least") * percent)
        & (F.col("most") >= F.col("n") * percent)).select("key", "node").distinct()
    outside = staged(known.join(outside, ["key", "node"], "left_semi"), "outside")
    once = F.array_min(F.array_intersect("keys", "_keys")) == F.col("key")
    return _ends(_joined(outside, known, "key", "common", percent).where(once & _alike()))


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, n_shingles, component_id, kept: one row per document."""
    signed = staged(signatures(docs, width, id_col, text_col), "signatures")
    same = ["n", "set_a", "set_b"]
    heads = signed.where("n > 0").groupBy(same).agg(F.min("node").alias("head")).where("head is not null")
    nodes = staged(
        signed.join(heads.withColumnRenamed("head", "node"), [*same, "node"], "left_semi")
        .dropDuplicates(["node", *same]),
        "nodes",
    )
    reached = None

    def linked(pairs: DataFrame, label: str) -> bool:
        """Merges the components that pairs of similar sets join; whether there are any."""
        nonlocal reached
        pairs, number = staged_rows(pairs, label)
        if number:
            links, number = staged_rows(_confirmed(docs, pairs, percent, width, id_col, text_col), "links")
        if number:
            reached = _merged(reached, links)
        return number > 0

    for masked in (False, True):
        linked(_to_head(_placed(nodes, reached), masked, percent), "head-pairs")

    # Masked keys whose members are not all linked, with what each member shares with any other.
    rest, number = _unlinked(_placed(nodes, reached))
    if number:
        shared = _shared_with_others(docs, rest, percent, width, id_col, text_col)
        rest = staged(
            rest.join(shared.drop("prefix"), "node").where(F.col("shared") * 100 >= F.col("n") * percent), "rest")
        if linked(_to_center(rest, percent), "center-pairs"):
            rest = _placed(rest.drop("component"), reached)
            rest = staged(rest.join(_split_keys(rest), "key", "left_semi"), "rest")
        linked(_by_common(rest, percent).unionByName(_by_rare(rest, shared, percent)).distinct(), "cross-pairs")

    found = signed.select("node", *same).join(heads, same, "left")
    if reached is None:
        found = found.withColumn("component", F.col("head"))
    else:
        found = found.join(reached.select(F.col("node").alias("head"), F.col("component")), "head", "left")
    component = F.coalesce("component", "head", "node")
    return found.select(
        F.col("node").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("node"), F.lit(True)).alias("kept"),
    )


def first_of_each(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that are kept; rows of one id stay or go together."""
    found = near_duplicates(docs, id_col=id_col, **options)
    gone = found.where(~F.col("kept")).select(F.col(id_col).alias("_gone"))
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")


def groups_sql(table: str = "documents", width: int = 5, percent: int = 80) -> str:
    """DuckDB SQL of ``near_duplicates`` by all pairs that share a shingle; for small tables."""
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    return f"""
        WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+') AS w FROM {table}),
        places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {width - 1}, 1) + 1)) AS i FROM words WHERE len(w) > 0),
        shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + {width - 1}], ' ') AS shingle FROM places),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a
            JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * s.n >= {percent} * (x.n + y.n - s.n)),
        reach(doc_id, root) AS (
            SELECT doc_id, doc_id FROM {table} UNION SELECT b, root FROM reach JOIN links ON a = reach.doc_id),
        roots AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept
        FROM roots LEFT JOIN sizes USING (doc_id)"""
