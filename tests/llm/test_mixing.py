"""Targets and quotas, exactly; rows of the mix against the plan."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneflow.llm import mixing as m
from paneflow.llm import queries

SCHEMA = "doc_id long, text string, source string, shard string, n_chars long"


def docs_of(spark):
    rows = [(i, "w " * (i % 37), f"s{i % 5}", "x", 1) for i in range(400)]
    rows += [(900, None, "s1", "x", 1), (901, "a b", None, "x", 1), (901, "a b", None, "x", 1),
             (None, "q r s", "s2", None, None), (902, "", "empty", "x", 1), (903, "big " * 50_000, "s4", "x", 1)]
    return spark.createDataFrame(rows, SCHEMA)


def targets(sizes, share=1.5):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: m.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, filled = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in filled]
        rest = total - sum(filled.values())
        got = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if got[s] > 2 * sizes[s]]
        if not over:
            return filled | got
        filled |= {s: 2.0 * sizes[s] for s in over}


def test_targets_and_taken_words(spark):
    dealt = m.deal(m.plan_mix(docs_of(spark)), shards=6, block_words=64)
    rows = dealt.select("source", "_mix.*", m.taken_words().alias("taken")).collect()
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    want = targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert taken[s] == round(target[s])


def taken_by_hand(rows, shards, block_words, seed=m.SEED):
    """Words taken of (id, text) in a plain walk over every shard's blocks."""
    streams, target = {}, {}
    for doc_id, text, source in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        name = "" if doc_id is None else str(doc_id)
        digest = hashlib.md5((text or "").encode()).hexdigest()
        key = hashlib.md5(f"{m.SEED}|{name}|{digest}".encode()).hexdigest()
        streams.setdefault(source, []).append((key, doc_id, text, len(words)))
    sizes = {s: sum(d[3] for d in docs) for s, docs in streams.items()}
    target = targets(sizes)
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    recipe = m.draw_recipe([(i, sizes[s], round(target[s])) for i, s in enumerate(names)], shards, block_words, seed)
    taken = {}
    for (rank, draws), source in zip(recipe, names):
        owner = [(doc_id, text) for _, doc_id, text, n in sorted(streams[source], key=lambda d: d[0]) for _ in range(n)]
        for _, whole, step, shift, starts, ends, last, last_words, end_words, _ in draws:
            place = {(b * step + shift) % whole: b for b in range(whole)} if whole else {}
            assert len(place) == whole
            for shard in range(shards):
                for p in range(starts[shard], ends[shard]):
                    at = place[p] * block_words
                    for who in owner[at:at + (last_words if p == last else block_words)]:
                        taken[who] = taken.get(who, 0) + 1
            for who in owner[whole * block_words:whole * block_words + end_words]:
                taken[who] = taken.get(who, 0) + 1
    return taken


@pytest.mark.parametrize("shards, block_words", [(6, 64), (1, 64), (5, 7), (4, 4096)])
def test_the_draws_against_a_plain_walk(spark, shards, block_words):
    docs = docs_of(spark).distinct()
    dealt = m.deal(m.plan_mix(docs), shards=shards, block_words=block_words)
    got = {(r.doc_id, r.text): r.taken for r in
           dealt.select("doc_id", "text", m.taken_words().alias("taken")).collect() if r.taken}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert got == taken_by_hand(rows, shards, block_words)


def test_another_tree_draws_other_words(spark):
    plan = m.plan_mix(docs_of(spark))

    def totals_and_rows(**how):
        dealt = m.deal(plan, block_words=16, **how).select("doc_id", "source", m.taken_words().alias("taken"))
        rows = dealt.collect()
        totals = {}
        for r in rows:
            totals[r.source] = totals.get(r.source, 0) + r.taken
        return totals, sorted((str(r.doc_id), r.taken) for r in rows)

    one, other, fewer = (totals_and_rows(**h) for h in ({"shards": 8}, {"shards": 8, "seed": 5}, {"shards": 3}))
    assert one[0] == other[0] == fewer[0]
    assert one[1] != other[1] and one[1] != fewer[1]


def test_words_of_the_mix_are_those_drawn(spark):
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(i % 50)), f"s{i % 3}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    dealt = m.deal(m.plan_mix(docs), shards=4, block_words=20)
    ranges = {(r.doc_id, r["pass"]): r.ranges for r in dealt.select(
        "doc_id", F.explode("_mix_rounds").alias("r")).select("doc_id", "r.pass", "r.ranges").collect()}
    mixed = m.mix(dealt).collect()
    assert len(mixed) == len(ranges)
    for r in mixed:
        words = [w for x in ranges[r.doc_id, r["pass"]] for w in range(x["at"], x["at"] + x["words"])]
        assert r.text.split() == [f"d{r.doc_id}w{j}" for j in words]


def test_clashing_names(spark):
    docs = docs_of(spark).select(
        "*", *[F.lit(1).alias(c) for c in ("target", "before", "source_size", "_of_range", "range", "words",
                                           "size", "_mix", "_mix_range", "_rank", "pass", "order_key")])
    dealt = m.deal(m.plan_mix(docs), shards=3, block_words=64)
    assert [c for c in dealt.columns if not c.startswith("_mix")] == [c for c in docs.columns if not c.startswith("_mix")]
    assert dealt.filter("target = 1 AND before = 1 AND _of_range = 1").count() == docs.count()
    plain = m.mix(m.deal(m.plan_mix(docs_of(spark)), shards=3, block_words=64))
    same = ["doc_id", "text", "source", "shard", "order_key", "pass", "words"]
    assert m.mix(dealt).select(same).exceptAll(plain.select(same)).count() == 0


def test_draws_beyond_the_generator():
    """Mean and spread of large draws are those of the distribution; halves add up."""
    have, rest, n = 1_500_000_000, 2_500_000_000, 1_000_000_000
    got = np.array([m._one_colour(np.random.default_rng(i), have, rest, n) for i in range(60)], dtype=float)
    p = have / (have + rest)
    spread = np.sqrt(n * p * (1 - p) * (have + rest - n) / (have + rest - 1))
    assert len(set(got)) > 50
    assert abs(got.mean() - n * p) < 4 * spread / np.sqrt(len(got))
    assert 0.6 * spread < got.std() < 1.5 * spread
    split = m.split_quotas([2_000_000_000, 3_000_000_000, 7, 0], 4)
    assert split.sum(axis=0).tolist() == [2_000_000_000, 3_000_000_000, 7, 0]
    assert split.min() >= 0
    assert m._one_colour(np.random.default_rng(1), 10**9, 2, 10**9 + 2) == 10**9
    assert m._one_colour(np.random.default_rng(1), 3, 10**10, 0) == 0


def test_query_gives_targets_and_draws(spark, tmp_path):
    docs_of(spark).distinct().write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op7_mixing(spark, str(tmp_path)).collect()
    rows = [(r.doc_id, r.text, r.source) for r in docs_of(spark).distinct().collect()]
    want = taken_by_hand(rows, m.SHARDS, m.BLOCK_WORDS)
    assert sorted(r.taken for r in got if r.taken) == sorted(want.values())
    assert all((r.shards == "") == (r.taken == 0) for r in got)
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + len((r[1] or "").split())
    assert sorted({r.source_size for r in got}) == sorted(set(sizes.values()))
    assert len(got) == len(rows)


def test_mix_rows_follow_the_plan(spark):
    dealt = m.deal(m.plan_mix(docs_of(spark)), shards=6, block_words=64)
    mixed = m.mix(dealt)
    planned = dealt.select(F.sum(m.taken_words())).first()[0]
    assert mixed.agg(F.sum("words")).first()[0] == planned
    assert mixed.filter(m.n_words(F.col("text")) != F.col("words")).count() == 0
    assert mixed.filter("shard < 0 OR shard >= 6 OR shard IS NULL").count() == 0
    again = m.mix(m.deal(m.plan_mix(docs_of(spark)), shards=6, block_words=64))
    assert again.exceptAll(mixed).count() == 0
    assert mixed.columns[:5] == ["doc_id", "text", "source", "shard", "n_chars"]


def test_quotas_are_exact_and_even():
    quotas = [1000, 17, 0, 333, 5]
    split = m.split_quotas(quotas, 8)
    assert split.sum(axis=0).tolist() == quotas
    totals = split.sum(axis=1)
    assert totals.max() - totals.min() <= 3
    assert np.array_equal(split, m.split_quotas(quotas, 8))


def test_empty(spark, tmp_path):
    empty = docs_of(spark).limit(0)
    assert m.mix(m.deal(m.plan_mix(empty))).count() == 0
    blank = docs_of(spark).withColumn("text", F.lit(""))
    assert m.mix(m.deal(m.plan_mix(blank))).count() == 0


def test_shards_are_written(spark, tmp_path):
    mixed = m.mix(m.deal(m.plan_mix(docs_of(spark)), shards=3, block_words=64))
    path = m.write_shards(mixed, str(tmp_path / "mix"))
    assert spark.read.parquet(path).count() == mixed.count()
