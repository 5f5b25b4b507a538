import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tracewright.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = bpe.Encoder(bpe.Vocabulary(bpe.read_vocabulary(PATH)))


def both(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    own = next(ENCODER.encoded([text]))
    return own, (" ".join(map(str, ids)), LIBRARY.decode(ids, skip_special_tokens=False))


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("the sΣİÉ\u0301'7½\u0085\u00a0\x1c\n"), st.characters(codec="utf-8"))))
def test_same_as_library(text):
    own, library = both(text)
    assert own == library


@pytest.mark.parametrize("text", [
    "", " ", "It's the dogs' 1999 <|endoftext|>x<|startoftext|>", "a" * 3000, "ab" * 70 + " " + "zq" * 33,
    "unbelievably" * 40, "!!!" * 50 + "👍" * 30, "the " * 5000,
])
def test_edges(text):
    own, library = both(text)
    assert own == library


def test_long_word_is_merged_as_in_a_batch():
    vocabulary = ENCODER.vocabulary
    for word in (b"internationalization", b"a", b"thethethe", b"x" * 60):
        symbols = vocabulary.symbols(word)
        assert bpe.merge_one(vocabulary, symbols) == bpe.merge_batch(vocabulary, [symbols], 64)[0]


def test_frames(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "y"), (3, "The cat", None), (3, "The cat", None)],
        "doc_id bigint, text string, n_tokens string",
    )
    rows = bpe.encoded(docs, PATH).orderBy("doc_id").collect()
    assert [r.n_tokens for r in rows] == [0, 0, 2, 2]
    assert rows[2].decoded == "the</w> cat</w>" and rows[0].token_ids == ""
    assert bpe.digests(docs, PATH).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert bpe.digests(docs.limit(0), PATH).count() == 0
