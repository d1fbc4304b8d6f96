"""Counts against plain versions, the forest against its definition, verdicts on labelled rows."""

import collections
import math
import random

import duckdb
import numpy as np
import pytest

from paneflow.llm import quality_forest as forest
from paneflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(text):
    words = text.encode().split()
    windows = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return (len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered))


def test_counts_of_odd_texts():
    kinds = forest.character_kinds()
    rng = random.Random(1)
    texts = ["", " ", "a", "a a a a a", "a a a a a a", "x y\n\nx y\n \n \nx y\r", "# * | a| b",
             "　 漢 é\x85x\x0b\x1cy", "A B C", "😀 <> 😀", "a b c d e f a b c d e z a b c d", "w " * 5000]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(300)]
    texts += ["".join(rng.choice("ab# \n") for _ in range(rng.randrange(60))) for _ in range(300)]
    for text in texts:
        got = dict(zip(forest.STATISTICS, forest.statistics(text, kinds)))
        assert tuple(got.values())[:5] == plain(text), text
        words = text.encode().split()
        letters = [c for c in text if c.isalpha()]
        assert (got["n_upper"], got["n_letters"]) == (sum(c.isupper() for c in letters), len(letters))
        if text.isascii():
            assert got["n_bare_words"] == sum(
                not any(c.isalnum() or not c.isprintable() for c in w.decode()) for w in words), text


def test_scores_follow_the_paths():
    rng = np.random.default_rng(3)
    sample = rng.normal(size=(400, 3))
    grown = forest.grow(sample, trees=20, subsample=64)
    points = np.concatenate([rng.normal(size=(50, 3)), [[9.0, 9, 9], [0, 0, 0]]])
    want = []
    for x in points:
        total = 0.0
        for t in range(20):
            node = 0
            while grown.feature[t, node] >= 0:
                node = grown.left[t, node] + int(x[grown.feature[t, node]] >= grown.split[t, node])
            total += grown.path[t, node]
        harmonic = math.log(63) + 0.5772156649015329
        want.append(2 ** (-total / 20 / (2 * harmonic - 2 * 63 / 64)))
    got = grown.scores(points)
    assert np.allclose(got, want)
    assert got[-2] == got.max() and got[-2] > 0.6 > got[-1]


def test_split_of_equal_and_few_rows():
    assert forest.grow(np.ones((300, 2)), trees=3).scores(np.ones((4, 2))).shape == (4,)
    assert forest.grow(np.ones((1, 2)), trees=3).scores(np.zeros((1, 2))).shape == (1,)
    close = np.array([[1.0], [np.nextafter(1.0, 2)]])
    assert forest.grow(close, trees=2).scores(close).shape == (2,)


def test_threshold_weighs_good_against_bad():
    bins = [(10, 1000, 0), (12, 4, 3), (15, 1, 50), (20, 0, 40)]
    assert forest.best_threshold(bins, 0.005) == 12 / forest.BINS
    assert forest.best_threshold(bins, 0.002) == 15 / forest.BINS
    assert forest.best_threshold([(1, 5, 0)]) is None and forest.best_threshold([]) is None
    assert forest.best_threshold([(9, 900, 1), (10, 1, 0)]) is None


@pytest.fixture(scope="module")
def judged(spark):
    return QUERIES["op11_quality_forest"](spark, SF).collect()


def test_whole_table_against_plain_counts_and_labels(judged):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    assert len(judged) == len(texts)
    for r in judged:
        counts = plain(texts[r.doc_id] or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (r.base_failed and r.kept)
    passed = [r for r in judged if not r.base_failed and r.doc_id in labels]
    good = [r.kept for r in passed if labels[r.doc_id] == 1]
    bad = [r.kept for r in passed if labels[r.doc_id] == 0]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.1


def test_unlabelled_documents_are_judged_as_well(judged):
    """Half of the labels fix the threshold, the other half is as well separated."""
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    own = [(int(r.score * forest.BINS), labels[r.doc_id], r.doc_id % 2)
           for r in judged if not r.base_failed and r.doc_id in labels]
    bins = collections.Counter((b, q) for b, q, half in own if half)
    threshold = forest.best_threshold([(b, bins[b, 1], bins[b, 0]) for b in {b for b, _ in bins}]) * forest.BINS
    good = [b < threshold for b, q, half in own if not half and q == 1]
    bad = [b < threshold for b, q, half in own if not half and q == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.2


def test_nulls_repeats_clashing_names_and_empty_tables(spark):
    text = "the quick brown fox jumps over the lazy dog again and again until noon"
    rows = [(1, text, "a"), (1, text, "b"), (2, None, "c"), (3, "", "d"), (None, text, "e"), (4, "few words", "f"),
            (5, "same five words come back " * 30, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0), (7, 0)], "doc_id long, quality int")
    got = sorted((r.doc_id or 0, r.base_failed, r.kept) for r in forest.judge(docs, labels).collect())
    assert got == [(0, False, True), (1, False, True), (1, False, True), (2, True, False), (3, True, False),
                   (4, True, False), (5, True, False)]
    assert forest.judge(docs.limit(0), labels).count() == 0
    assert forest.judge(docs, labels.limit(0)).filter("kept").count() == 3
