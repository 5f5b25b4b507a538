import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
import public_tokenizers

import corpus_pipeline
from tracewright.llm import decontaminate
from tests.llm.test_minhash_hamming import plain as plain_groups
from tests.llm.test_suffix_dedup import plain as plain_repeats
from tests.llm.test_toxicity import corpus

ITEM = "the seven grey wizards of the northern tower counted every falling star above the quiet harbour town"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with toxic ones, copies, a shared passage and a benchmark item."""
    place = tmp_path_factory.mktemp("tables")
    rng = random.Random(1)
    rows = corpus(300, 9)
    texts = {i: t for i, t, _ in rows}
    clean = [i for i, _, y in rows if not y and len(texts[i].split()) > 60]
    passage = " ".join(rng.choice(texts[clean[0]].split()) for _ in range(55))
    for k, i in enumerate(clean[1:5]):
        texts[i] = f"{texts[i]}\n{passage}"
    texts[clean[6]] += " " + ITEM.upper()
    texts[1000] = texts[clean[7]]
    words = texts[clean[8]].split()
    texts[1001] = " ".join(words[:-1] + ["changed"])
    texts[1002], texts[1003] = None, ""
    spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts.items()],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    ).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{place}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(f"{place}/benchmark.parquet")
    return str(place), texts, {i: y for i, _, y in rows}


def test_each_stage_against_plain_code(spark, folder):
    place, texts, toxic = folder
    docs = spark.read.parquet(f"{place}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = {r.doc_id: r.text for r in stages["toxicity"](spark, docs, place).collect()}
    wrong = [i for i, y in toxic.items() if (i in kept) == bool(y)]
    assert len(wrong) < 0.05 * len(toxic)

    frame = docs.where(docs.doc_id.isin(list(kept)))
    near = stages["minhash near-dedup"](spark, frame, place)
    assert near.columns == docs.columns
    groups = plain_groups(list(kept.items()), 5)
    kept = {r.doc_id: r.text for r in near.collect()}
    assert set(kept) == {i for i, v in groups.items() if v[2]} and not {1000, 1001} & set(kept)

    frame = docs.where(docs.doc_id.isin(list(kept)))
    cut = stages["suffix-array dedup"](spark, frame, place)
    assert cut.columns == docs.columns
    expected = {r[0]: r[4].decode("utf-8", "ignore") for r in plain_repeats([(i, (t or "").encode()) for i, t in kept.items()])}
    rows = cut.collect()
    assert {r.doc_id: r.text or "" for r in rows} == expected
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
    assert any(expected[i] != (kept[i] or "") for i in kept)

    rows = stages["benchmark decontamination"](spark, cut, place).collect()
    item = decontaminate.normal(ITEM)
    assert {r.doc_id for r in rows} == {i for i, t in expected.items() if item not in decontaminate.normal(t)}


def test_run(spark, folder):
    place, texts, toxic = folder
    rows = corpus_pipeline.run(spark, place).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.token_ids == " ".join(map(str, ids)) and r.n_tokens == len(ids)
    assert len({r.doc_id for r in rows}) == len(rows) and 0 < len(rows) < len(texts)
    assert corpus_pipeline.ORACLE_SQL is None and [len(s) for s in corpus_pipeline.STAGES] == [2] * 5


def test_stages_keep_clashing_columns_apart(spark, folder):
    place, _, _ = folder
    docs = spark.read.parquet(f"{place}/documents.parquet").limit(20)
    names = ("n_tokens", "token_ids", "score", "predicted", "spans", "kept", "item_id", "_found", "key", "node")
    docs = docs.withColumns({n: F.lit("mine") for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, place).columns == docs.columns, name
    found = corpus_pipeline.as_tokens(spark, docs, place)
    assert len(set(found.columns)) == len(found.columns) and dict(found.dtypes)["n_tokens"] == "bigint"
    assert found.count() == 20
