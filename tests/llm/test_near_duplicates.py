"""Near duplicates of texts and vectors against comparing everything with everything."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneflow.llm import embedding_dedup, ngram_join
from paneflow.llm.components import connected_components


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: root(n) for n in nodes}


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))}


def texts():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    passage = [f"p{i}" for i in range(60)]
    out = [None, "", "  \t\n", "one", "One", "one two", "two one", "one two three", "A b C", "a B c"]
    for size in (15, 40, 90, 300):
        for _ in range(4):
            base = [rng.choice(words) for _ in range(size)]
            for edits in [0, 0, 0, 1, 1, 1, 2, 2, 3, 4, 6]:
                copy = list(base)
                for _ in range(edits):
                    copy[rng.randrange(size)] = rng.choice(words)
                out.append(" ".join(copy))
    out += [" ".join(passage + [rng.choice(words) for _ in range(rng.randrange(3, 200))]) for _ in range(60)]
    out.append("x " * 60_000)
    return out


@pytest.mark.parametrize("rare_most", [8, 1])
def test_texts(spark, monkeypatch, rare_most):
    monkeypatch.setattr(ngram_join, "RARE_MOST", rare_most)
    rows = [(i, t, "c") for i, t in enumerate(texts())]
    rows += [(3, rows[3][1], "c"), (None, "one two three", "c"), (None, None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string").repartition(3)
    sets = {i: shingles(t) for i, t, _ in rows if i is not None}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    want = components(sets, links)
    got = ngram_join.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert r.n_shingles == len(sets[r.doc_id])
            assert r.component_id == want[r.doc_id]
    assert sorted((r.component_id is None) for r in got if r.doc_id is None) == [False, True]
    assert ngram_join.near_duplicates(docs.limit(0)).count() == 0


def test_group_of_near_copies(spark, monkeypatch):
    """120 variants of one text, most of which link but not with the first pivots: the pairs
    that the last join leaves do not grow with the group's entries."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(words[:1] + [w if rng.random() < 0.985 else f"x{rng.random()}" for w in words[1:]]))
            for i in range(120)]
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b
             and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    want = components(sets, links)
    paired, made = ngram_join._paired, []

    def counted(pairs, *rest):
        made.append(pairs.count())
        return paired(pairs, *rest)

    monkeypatch.setattr(ngram_join, "_paired", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    last = []
    # With entries of every size left to the last join, and with the pivots drawn for them.
    for crowded in (1_000_000, ngram_join.CROWDED):
        monkeypatch.setattr(ngram_join, "CROWDED", crowded)
        got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()}
        assert got == want and len(links) > 500
        last.append(made[-1])
    assert len(made) == 5 and last[1] * 4 < last[0]


def test_costly_tests_only_for_pairs_that_sizes_allow(spark, monkeypatch):
    """Which entry a pair leaves is asked only of pairs whose sizes allow a link: the division
    fails for any other. It guards the order of the tests, not their time."""
    meet_here = ngram_join._meet_here

    def checked(a, b, entry):
        probe = F.lit(1) / F.when(ngram_join._sizes_allow(a, b, ngram_join.PERCENT), 1).otherwise(0)
        return meet_here(a, b, entry) & (probe > 0) & (probe < 2)

    monkeypatch.setattr(ngram_join, "_meet_here", checked)
    monkeypatch.setattr(ngram_join, "CROWDED", 1)
    # Five texts of four lengths share a passage of their own, which their prefixes hold.
    common = [f"w{i}" for i in range(240)]
    rows = []
    for g in range(8):
        for size in (60, 120, 180, 240, 240):
            words = [f"p{g}_{i}" for i in range(30)] + common[:size] + [f"e{len(rows)}"]
            rows.append((len(rows), " ".join(words)))
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b
             and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()}
    assert got == components(sets, links)


def vectors():
    rng = np.random.default_rng(4)
    rows, node = [], 0
    for label in (0, 1):
        for _ in range(40):
            base = rng.normal(size=8)
            for noise in (0.0, 0.0, 0.05, 0.12, 0.2):
                rows.append((node, [float(x) for x in np.float32(base + noise * rng.normal(size=8))], label))
                node += 1
    rows.append((node, [2.0 * x for x in rows[0][1]], 0))
    return rows


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 37)
    rows = vectors()
    n = len(rows)
    odd = [(n, None, 0), (n + 1, [0.0] * 8, 0), (n + 2, [1.0] * 7 + [None], 0), (n + 3, [math.nan] * 8, 0),
           (n + 4, [math.inf] * 8, 0), (n + 5, rows[0][1], None), (n + 6, [1.0, 2.0], 0), (None, rows[0][1], 0)]
    frame = spark.createDataFrame(
        [(i, v, k, 1) for i, v, k in rows + odd], "vec_id long, embedding array<float>, label int, copies int"
    ).repartition(3)
    unit = {i: np.array(np.float32(v), dtype=float) for i, v, _ in rows}
    label = {i: k for i, _, k in rows}
    links = [(a, b) for a in unit for b in unit if a != b and label[a] == label[b]
             and unit[a] @ unit[b] / math.sqrt((unit[a] @ unit[a]) * (unit[b] @ unit[b])) >= 0.93]
    want = components(unit, links)
    extra = unit[0]
    for r in embedding_dedup.near_duplicates(frame).collect():
        if r.vec_id is None:
            continue
        if r.vec_id >= n:
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
            continue
        near = sum(a == r.vec_id for a, _ in links)
        # The row without an id equals row 0 and counts as another vector.
        own = unit[r.vec_id]
        if label[r.vec_id] == 0 and own @ extra / math.sqrt((own @ own) * (extra @ extra)) >= 0.93:
            near += 1
        assert r.n_links == near
        assert r.component_id == want[r.vec_id] and r.kept == (r.vec_id == want[r.vec_id])
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0
    assert embedding_dedup.near_duplicates(frame.filter("label IS NULL")).count() == 1


def test_every_length_links(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0], 0) for i in range(5)] + [(5, [1.0, 2.0], 0), (6, [2.0, 4.0], 0), (7, [2.0, -1.0], 0)]
    rows += [(8 + i, [float(x) for x in np.eye(40)[i % 2]], 0) for i in range(4)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(frame).collect()}
    want = {i: (4, 0) for i in range(5)} | {5: (1, 5), 6: (1, 5), 7: (0, 7), 8: (1, 8), 9: (1, 9), 10: (1, 8), 11: (1, 9)}
    assert got == want


def test_recall_and_probes_on_planted_vectors(spark):
    """6,000 vectors of 64 dimensions, half in clusters, half without structure, 1,500 of
    them near copies just above the threshold, where the index can miss most."""
    rng, dims = np.random.default_rng(6), 64
    centres = rng.normal(size=(100, dims))
    base = np.concatenate([centres[rng.integers(0, 100, 2250)] + 0.7 * rng.normal(size=(2250, dims)),
                           rng.normal(size=(2250, dims))])
    base /= np.linalg.norm(base, axis=1)[:, None]
    source = base[::3]
    turn = rng.normal(size=source.shape)
    turn -= (turn * source).sum(1)[:, None] * source
    turn /= np.linalg.norm(turn, axis=1)[:, None]
    cosine = rng.uniform(0.932, 0.97, size=(len(source), 1))
    unit = np.concatenate([base, cosine * source + np.sqrt(1 - cosine**2) * turn])
    links = np.argwhere(np.triu(unit @ unit.T >= 0.93, 1))
    degree = np.bincount(links.ravel(), minlength=len(unit))
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(unit)],
                                  "vec_id long, embedding array<double>, label int").repartition(4)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(frame).collect()}
    found = np.array([got[i].n_links for i in range(len(unit))])
    assert (found <= degree).all() and found.sum() % 2 == 0
    assert len(links) >= 1500 and found.sum() >= 0.99 * degree.sum()
    real = components(range(len(unit)), links.tolist())
    assert np.mean([got[i].component_id == real[i] for i in got]) > 0.98
    index = embedding_dedup.fit(embedding_dedup.unit_rows(unit), len(unit))
    cell, square = index.nearest(unit)
    share = embedding_dedup.probes(square, cell, index.gaps(), embedding_dedup.margin(dims, 0.93)).mean()
    assert share < 0.1


def test_components(spark):
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 240)]
    loose = [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)]
    edges = path + star + loose + [(5, 5), (None, 3), (7, 200)]
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == components({x for e in real for x in e}, real)
