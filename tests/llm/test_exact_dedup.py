"""Recipes against plain grouping of texts."""

import hashlib

from pyspark.sql import functions as F

from paneflow.llm import exact_dedup as d

SCHEMA = "doc_id long, text string, kept string"


def brute(rows):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t, _ in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def rows():
    long = "word. " * 40_000
    return [(1, "a", "x"), (2, "a", "x"), (2, "a", "x"), (3, None, "x"), (4, "", "x"), (None, "b", "x"),
            (None, "b", "x"), (5, long, "x"), (6, long, "x"), (7, long + "!", "x"), (8, "é" * 20_000, "x"),
            (9, " ", "x"), (10, "a ", "x"), (11, "x\n" * 9000, "x")]


def found(frame):
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in frame.collect()]
    return sorted(got, key=repr)


def test_odd_rows(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    assert found(d.find_copies(docs)) == brute(rows())
    assert d.find_copies(docs.limit(0)).count() == 0


def test_colliding_identifiers_are_widened(spark):
    """With a hash of two values the identifiers must grow until they are unique."""
    docs = spark.createDataFrame(rows(), SCHEMA)
    weak = lambda c, seed: F.pmod(F.xxhash64(F.lit(seed), c), F.lit(2))
    assert d.verified_width(docs, "text", weak, 1) > 2
    assert found(d.find_copies(docs, hashed=weak, width=1)) == brute(rows())


def test_chunks_join_to_the_text(spark):
    docs = spark.createDataFrame(rows(), SCHEMA).filter("text IS NOT NULL")
    joined = F.array_join(d.chunks(F.col("text")), "")
    assert docs.filter(joined != F.col("text")).count() == 0
    assert docs.filter(F.exists(d.chunks(F.col("text")), lambda c: F.length(c) > d.MAX_CHUNK)).count() == 0


def test_dropped_rows(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    kept = sorted((r.doc_id or 0) for r in d.drop_copies(docs).collect())
    assert kept == [0, 0, 2, 2, 4, 6, 7, 8, 9, 10, 11]
