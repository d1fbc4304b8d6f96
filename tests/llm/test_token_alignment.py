"""Alignment by chunks and spans against whole texts tokenized at once, byte by byte."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from paneflow.llm import token_alignment as alignment

ODD = ["", " ", "  ", "a ", " a", "a  b", "▁", "a▁b", "x\ny\tz", "\x00a", "<s> </s> <|endoftext|>",
       "é​ ", "　a　 b", "汉字 漢", "😀 😀x 👨‍👩‍👧", "a" * 3000, "  " * 40 + "z", "ß  ü q ", "don't  we'll \n\n I'd",
       "<0x41> <0xE6>漢", "\x1c a \x85b  c", "0 12 345 6789", "é ñandú Ελληνικά кириллица عربى", "a\r\nb \r\n c"]


@pytest.fixture(scope="module")
def models():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        byte_bpe = file.read()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return byte_bpe, file.read()


def plain(rows, models):
    a = tokenizers.Tokenizer.from_str(models[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=models[1])
    # The byte alphabet once more, from the printable ranges of Latin-1.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {c: c for c in printable}
    for byte in range(256):
        if byte not in letters:
            letters[byte] = 256 + len(letters) - len(printable)
    back = {chr(c): byte for byte, c in letters.items()}
    vocab = {i: t for t, i in a.get_vocab().items()}
    texts, counts = [], collections.Counter()
    for doc_id, text in rows:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        bytes_a = [bytes(back[c] for c in vocab[i]) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                   else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            texts.append((doc_id, [], [], [], ""))
            continue
        owner_a = [k for k, t in enumerate(bytes_a) for _ in t]
        owner_b = [k for k, t in enumerate(bytes_b) for _ in t]
        links = sorted(set(zip(owner_a, owner_b)))
        groups, first = [], (0, 0)
        for at in range(1, len(whole) + 1):
            ends = at == len(whole) or (owner_a[at] != owner_a[at - 1] and owner_b[at] != owner_b[at - 1])
            if ends:
                last = (owner_a[at - 1] + 1, owner_b[at - 1] + 1)
                groups.append(",".join(map(str, ids_a[first[0]:last[0]])) + "|"
                              + ",".join(map(str, ids_b[first[1]:last[1]])))
                first = last
        pairs = [(ids_a[x], ids_b[y]) for x, y in links]
        counts.update(pairs)
        texts.append((doc_id, ids_a, ids_b, pairs, ";".join(groups)))
    best = collections.Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted((
        (doc_id, len(ids_a), len(ids_b), groups.count("|"), len(pairs), sum(counts[p] == best[p[1]] for p in pairs),
         sum(counts[p] for p in pairs), hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        for doc_id, ids_a, ids_b, pairs, groups in texts), key=repr)


def check(docs, models):
    got = alignment.align(docs, *models)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, models)


def test_odd_repeated_and_null_texts_in_many_blocks(spark, models, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 400)
    monkeypatch.setattr(alignment, "AT_ONCE", 30)
    rng = random.Random(11)
    alphabet = ["a", "b", " ", "  ", "é", "漢", "\n", "the", "ing ", "\U0001f600", "'s", "9", " ", "　", "ﬁ"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(50))) for _ in range(400)]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, None, 2), (5, texts[5], 3), (5, texts[5], 3)]
    check(spark.createDataFrame(rows, "doc_id long, text string, pair int").repartition(3), models)


def test_whole_table(spark, models):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), models)


def test_one_very_long_text(spark, models):
    rng = random.Random(2)
    text = "".join(rng.choice(["word ", "漢字", "\n", "Zz", "é "]) for _ in range(60_000))
    check(spark.createDataFrame([(1, text), (2, "word")], "doc_id long, text string"), models)


def test_empty_table_and_only_empty_texts(spark, models):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    check(docs, models)
    assert alignment.align(docs.limit(0), *models).count() == 0


def test_spans_are_refined_by_decoded_bytes():
    """A's first token ends within a character, its second one covers the rest and another."""
    longs = lambda *x: np.array(x, np.int64)
    tokens = alignment.Tokens(longs(7, 8, 9), longs(3), longs(0, 1, 1), longs(1, 2, 3), longs(1, 1, 2))
    assert alignment.byte_ends(tokens, longs(3), longs(0, 1, 3, 4)).tolist() == [1, 2, 4]
    # Byte-fallback tokens have empty spans but for the last.
    tokens = alignment.Tokens(longs(1, 2, 3, 4), longs(4), longs(1, 1, 1, 2), longs(1, 1, 2, 3), longs(1, 1, 2, 1))
    assert alignment.byte_ends(tokens, longs(3), longs(0, 1, 4, 5)).tolist() == [1, 2, 4, 5]


def test_chunks_that_are_not_given_back(models):
    aligner = alignment.Aligner(*models)
    fine, found = aligner.align(["one", "a▁b", "漢 two", "▁"])
    assert fine.tolist() == [True, False, True, False]
    alone = [aligner.align([c])[1] for c in ("one", "漢 two")]
    assert found.groups == [x.groups[0] for x in alone]
    assert found.pairs.tolist() == [p for x in alone for p in x.pairs.tolist()]
    assert aligner.align(["▁"])[1].groups == []
