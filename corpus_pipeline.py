"""The documents on their way to training data: five stages, each over all that the one before kept.

For every stage: an empty table stays empty, columns beside ``doc_id`` and ``text`` are
carried along whatever their names, and texts of any length are looked at whole.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import bpe, decontaminate, minhash_hamming, suffix_dedup, toxicity
from tracewright.llm.common import staged, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the random field, learnt from all labels, does not call toxic.

    Null and empty texts have the score of a text without offending words; repeated
    rows are judged alike; without labels of both kinds all documents are judged by the
    share of toxic labels.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(table(spark, sf_dir, "documents"), labels)
    return toxicity.scored(docs, model).where("predicted = 0").select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group.

    Null and empty texts are in no group and stay, as do rows without an id; rows that
    share an id stay or go together.
    """
    return minhash_hamming.first_of_each(docs, width=5, percent=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id holds; n_chars follows the text.

    Null and empty texts stay as they are. Bytes go, so a cut inside a character drops
    what is left of it.
    """
    found = suffix_dedup.cleaned(docs)
    return found.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars")))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs.

    Null and empty texts hold none; null and empty items are skipped; repeated rows are
    judged alike.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and a digest of the text that these decode to.

    Null texts count as empty and have no tokens. Columns of these names are replaced.
    """
    found = bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))
    digest = F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256")
    made = ("n_tokens", "token_ids", "decoded_sha256")
    return found.select(*[c for c in docs.columns if c not in made], *made[:2], digest)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("minhash near-dedup", without_near_copies),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("bpe encoding", as_tokens),
]

# Classifier, components and merges are not expressible in SQL; tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
