"""One query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, conversation_repair, decontaminate, embedding_dedup, license_scan, minhash_hamming, pitman_yor,
    quality, sharding, suffix_dedup, toxicity, url_filter, vector_codes,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]

# The rules that the URL query judges by.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files of a tree: source, language, document."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("/"), F.coalesce("source", F.lit("")), F.lit("/"), F.coalesce("lang", F.lit("")),
                    F.lit("/"), F.col("doc_id").cast("string"))
    return license_scan.scanned(docs.select("doc_id", path.alias("path"), "text"), "doc_id")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = suffix_dedup.without_repeats(docs)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def remainder(name: str):
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.encode(F.col(name).cast("string"), "utf-8")) % 5


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(remainder("doc_id") != 0)
    found = toxicity.scored(docs, toxicity.fit(docs, labels))
    held_out = F.coalesce(remainder("doc_id") == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judged(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(remainder("doc_id") == 1, F.lit(False))
    found = pitman_yor.scored(docs, ~held_out)
    return found.withColumn("held_out", ~F.col("learnt")).drop("learnt")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_hamming.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_copies(table(spark, sf_dir, "embeddings"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.matches(docs, items)


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(remainder("doc_id") != 0)
    found = quality.scored(docs, quality.fit(docs, labels))
    held_out = F.coalesce(remainder("doc_id") == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.coded(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damaged_and_repaired(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Query]:
    """All queries of the operators."""
    return {q.__name__: q for q in (
        op1_license_scan, op2_suffix_dedup, op3_toxicity, op4_url_filter, op5_sharding, op6_pitman_yor, op7_bpe,
        op8_minhash_dedup, op9_embedding_dedup, op10_decontaminate, op11_quality, op12_vector_codes, op13_conversation_repair,
    )}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of those that SQL can express."""
    files = """SELECT doc_id AS id, concat('/', source, '/', lang, '/', doc_id) AS path, text FROM documents"""
    rule, verdict = url_filter.rules_sql(URL_RULES)
    return {
        "op2_suffix_dedup": suffix_dedup.repeats_sql(),
        "op8_minhash_dedup": minhash_hamming.groups_sql(width=4),
        "op9_embedding_dedup": embedding_dedup.groups_sql(),
        "op12_vector_codes": vector_codes.codes_sql(),
        "op13_conversation_repair": conversation_repair.repair_sql(),
        "op1_license_scan": f"SELECT id AS doc_id, * EXCLUDE (id) FROM ({license_scan.scan_sql(files)})",
        "op4_url_filter": f"""
            WITH cut AS (
                SELECT page_id, CASE WHEN strpos(url, '://') > 0
                    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
            parts AS (
                SELECT page_id,
                    translate(regexp_extract(rest, '^[^/?#]*', 0),
                        '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
                    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
            SELECT page_id, host, path, {rule} AS rule,
                coalesce({verdict}, 'allow') AS verdict FROM parts""",
    }
