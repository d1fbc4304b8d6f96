"""Word-table encoding against the library on whole texts."""

import random

import public_tokenizers
import pytest
import sentencepiece

from paneflow.llm import sentencepiece_codec as codec

ODD = ["", " ", "  ", "a ", " a", "a  b", "▁", "a▁b", "x\ny\tz", "\x00a", "<s> </s>",
       "é​ ", "　a", "汉字 漢", "😀 😀x", "a" * 5000, "  " * 40 + "z", "ß  ü▁▁ q "]


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def test_null_odd_repeated_and_extra_columns(spark, model, monkeypatch):
    monkeypatch.setattr(codec, "BLOCK_BYTES", 300)
    rng = random.Random(3)
    alphabet = ["a", "b", " ", "  ", "▁", "é", "漢", "\n", "the", "ing ", "\U0001f600"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(300)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, None, "x"), (5, texts[5], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = codec.encode(docs, model).collect()
    assert len(got) == len(rows)
    own = sentencepiece.SentencePieceProcessor(model_proto=model)
    for r in got:
        text = "" if r.doc_id is None else texts[r.doc_id]
        ids = own.encode(text, add_eos=True)
        assert r.ids == ids, text
        assert r.decoded == own.decode(ids), text
    assert codec.encode(docs.limit(0), model).count() == 0


def test_whole_table_matches_the_library(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    own = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in codec.encode(docs, model).collect():
        ids = own.encode(texts[r.doc_id], add_eos=True)
        assert r.ids == ids and r.decoded == own.decode(ids)


def test_words_the_table_lacks_are_segmented(model):
    own = codec.load(model)
    words = codec.marked_words("two words")
    ids, changed = codec.segment(own, words)
    assert b"".join(ids) and not changed
