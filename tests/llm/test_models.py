"""Classifier and language model: held-out quality, base scores, odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paneflow.llm import pitman_yor, queries, seating, toxicity

SF = "/root/testdata/sf0.01"


def test_toxic_words_are_learnt(spark):
    rows = [(i, f"plain text number {i} " + ("you absolute scoundrel" if i % 3 == 0 else "good day"), int(i % 3 == 0))
            for i in range(240)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(900, None, "x"), (901, "", "x"), (None, "a", "x")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1, None), (None, 1), (900, 0), (4, 0), (4, 0)],
                                   "doc_id long, toxic int")
    learn = labels.filter(F.coalesce(F.col("doc_id") % 5 != 0, F.lit(False)))
    model = toxicity.train(docs, learn)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    wrong = sum((got[i] >= 0.5) != bool(y) for i, _, y in rows if i % 5 == 0)
    assert wrong == 0 and got[900] == got[901] and 0 <= got[901] <= 1
    assert toxicity.score(docs.limit(0), model).count() == 0
    again = toxicity.train(docs.repartition(5), learn)
    assert np.array_equal(model.weights, again.weights)


def test_one_kind_of_label(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    for label, score in ((0, 0.0), (1, 1.0)):
        labels = spark.createDataFrame([(1, label)], "doc_id long, toxic int")
        found = toxicity.score(docs, toxicity.train(docs, labels)).collect()
        assert all(r.score == pytest.approx(score) for r in found)
    none = toxicity.train(docs, labels.limit(0))
    assert none.score("x") == pytest.approx(0.0)


def test_slices_lose_no_ngram(monkeypatch):
    text = "abcdefghij" * 30
    whole = toxicity.distinct_slots(text)
    monkeypatch.setattr(toxicity, "SLICE", 16)
    assert np.array_equal(toxicity.distinct_slots(text), whole)


def test_language_model_base_and_held_out(spark):
    got = queries.op4_pitman_yor(spark, SF).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(docs)
    words = {i: [*t.encode().lower().split(), b""] for i, t in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    count = Counter(w for i in docs if not held[i] for w in words[i])
    n, v = sum(count.values()), len(count)
    for r in got:
        own = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(own), n)
        assert r.n_known == sum(count[w] > 0 for w in own)
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)
        assert r.base_score == pytest.approx(base)
        assert r.score < 0
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_spelling_adds_up():
    """After any two symbols, the probabilities of all symbols sum to 1."""
    rng = np.random.default_rng(3)
    words = pa.array([b"the", b"then", b"a", b"", b"other", b"the"], pa.binary())
    code, _ = pitman_yor.spelled(words)
    codes, counts = np.unique(code, return_counts=True)
    own = pitman_yor.sample_spelling(codes, counts * 3, pitman_yor.uniform_spelling(), rng)
    seen = dict(zip(own.triples.tolist(), own.mass.tolist()))
    for context in {int(c) // 257 for c in codes} | {5, 258 * 258 - 1}:
        total = sum(
            own.left[context] * own.pairs[context % 258, s] + seen.get(context * 257 + s, 0.0)
            for s in range(257)
        )
        assert total == pytest.approx(1.0)
    whole = own.log_prob(pa.array([b"the", b"zz"], pa.binary()))
    assert whole[0] > whole[1] and np.all(whole < 0)


def test_language_model_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "A b", "x"), (3, "A b", "x"), (None, "q", "x"), (4, "w " * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = pitman_yor.score_texts(docs, F.col("doc_id") != 4).collect()
    assert len(got) == len(rows)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2)} == {1}
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    assert pitman_yor.score_texts(docs.limit(0), F.col("doc_id") != 4).count() == 0
    blank = pitman_yor.score_texts(docs, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 for r in blank)


def test_stirling_numbers():
    d = 0.3
    table = seating.stirling(d, 4)
    assert math.exp(table[3, 2]) == pytest.approx(3 * (1 - d))
    assert math.exp(table[4, 1]) == pytest.approx((1 - d) * (2 - d) * (3 - d))
    x = np.array([0.01, 0.5, 3.0, 9.9, 10.1, 1e6])
    assert seating.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], abs=1e-9)


@pytest.mark.parametrize("c", [4, 24, 160, 300, 2000])
@pytest.mark.parametrize("weight", [0.001, 0.05, 2.0, 15.0, 400.0])
@pytest.mark.parametrize("d", [0.4, 0.8])
def test_seating_follows_its_distribution(c, weight, d):
    """Frequencies against the conditional: drawn from the table, from the closed sum, and
    by accepted seatings."""
    rng = np.random.default_rng(1)
    n = 5_000
    tables = None
    for _ in range(6):
        tables = seating.seat(np.full(n, c), np.full(n, weight), d, rng, tables)
    log = seating.stirling(d, c)[c, 1:] + math.log(weight) * np.arange(1, c + 1)
    expected = np.exp(log - log.max())
    expected /= expected.sum()
    at = np.arange(1, c + 1)
    mean, spread = (expected * at).sum(), math.sqrt((expected * at**2).sum() - (expected * at).sum() ** 2)
    seen = np.cumsum(np.bincount(tables, minlength=c + 1)[1:]) / n
    print(c, weight, d, np.abs(seen - np.cumsum(expected)).max(), tables.mean(), mean, spread)
    assert np.abs(seen - np.cumsum(expected)).max() < 0.03


def test_sweeps_reach_the_joint_distribution():
    """Two dishes of one restaurant: tables drawn at once, given the auxiliary variable,
    against the joint distribution of both, which holds the restaurant's total."""
    rng = np.random.default_rng(2)
    s, d, n, customers, parent = 1.5, 0.6, 30_000, (5, 3), (0.2, 0.1)
    tables = np.ones((n, 2), dtype=np.int64)
    for _ in range(12):
        given = seating.scale(s, d, tables.sum(axis=1), rng)
        tables = np.stack([seating.seat(np.full(n, c), given * p, d, rng)
                           for c, p in zip(customers, parent)], axis=1)
    numbers = seating.stirling(d)
    weight = np.array([[math.exp(numbers[5, a] + numbers[3, b]) * parent[0] ** a * parent[1] ** b
                        * math.prod(s + d * i for i in range(a + b)) for b in (1, 2, 3)] for a in range(1, 6)])
    seen = np.array([[((tables[:, 0] == a) & (tables[:, 1] == b)).mean() for b in (1, 2, 3)] for a in range(1, 6)])
    assert np.abs(seen - weight / weight.sum()).max() < 0.01


def test_every_context_has_a_restaurant(spark, monkeypatch):
    """Small blocks and buckets: counts, tables and probabilities against a plain recount."""
    monkeypatch.setattr(pitman_yor, "BLOCK_BYTES", 3_000)
    monkeypatch.setattr(pitman_yor, "BUCKET_BYTES", 5_000)
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{int(k)}" for k in rng.zipf(1.4, 60) if k < 400)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = {}
    learn = pitman_yor.learn

    def watched(vocab, pairs, known, buckets):
        kept.update(vocab=vocab, known=known, samples=learn(vocab, pairs, known, buckets))
        return kept["samples"]

    monkeypatch.setattr(pitman_yor, "learn", watched)
    scored = {r.doc_id: r for r in pitman_yor.score_texts(docs, F.col("doc_id") % 4 != 0).collect()}
    words, pairs = Counter(), Counter()
    for i, t in rows:
        own = [w.encode() for w in t.split()] + [b""]
        if i % 4:
            words.update(own)
            pairs.update(zip([b" ", *own], own))
    vocab = {}
    for r in pitman_yor.of(kept["vocab"], pitman_yor.VOCABULARY).collect():
        names = pitman_yor.unpack(r.body).column("word").to_pylist()
        vocab[r.to] = names
        assert all(c == words[w] for w, c in zip(names, pitman_yor.take(r.extra)[0]) if w != b" ")
    known = kept["known"]
    assert known.tokens == sum(words.values()) and known.distinct == len(words)
    for state, _, now in kept["samples"]:
        opened, customers, root = Counter(), Counter(), 0.0
        for r in state.collect():
            _, _, t, o, c, base = pitman_yor.take(r.body)
            assert np.all(t <= c) and np.all((t > 0) == (c > 0))
            opened.update(dict(zip(vocab[r.to], o.tolist())))
            customers.update(dict(zip(vocab[r.to], c.tolist())))
            root += float((c - known.root_discount * t).sum())
            root += (pitman_yor.STRENGTH["root"] + known.root_discount * now.root_tables) * float(base.sum())
        left = (pitman_yor.STRENGTH["root"] + known.root_discount * now.root_tables) * now.unknown
        assert (root + left) / (pitman_yor.STRENGTH["root"] + now.root_customers) == pytest.approx(1, abs=1e-4)
        assert sum(opened.values()) == sum(customers.values()) == now.root_customers
        for w in words:
            followers = [n for (u, _), n in pairs.items() if u == w]
            before = [n for (_, v), n in pairs.items() if v == w]
            assert len(followers) <= opened[w] <= sum(followers)
            assert len(before) <= customers[w] <= sum(before)
    out = [r for i, r in scored.items() if i % 4 == 0]
    assert len(scored) == 120 and sum(r.score for r in out) > sum(r.base_score for r in out)
    again = {r.doc_id: r.score for r in pitman_yor.score_texts(docs, F.col("doc_id") % 4 != 0).collect()}
    assert again == {i: r.score for i, r in scored.items()}
