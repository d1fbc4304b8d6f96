"""Archives: round trips, revisits, and odd rows."""

import base64
import gzip
import hashlib
import random

from paneflow.llm import queries, warc

SCHEMA = "page_id long, url string, html string, payload string"


def brute(rows, min_bytes=0):
    best = {}
    for page, _, html, _ in rows:
        key = (html or "").encode()
        best[key] = max(best.get(key, (False, 0)), (page is not None, page or 0))
    out = []
    for page, _, html, _ in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        top = best[raw]
        original = len(raw) < min_bytes or (page is not None, page or 0) == top
        refers = None if original or not top[0] else top[1]
        out.append((page, len(raw), digest, "response" if original else "revisit", refers))
    return sorted(out, key=repr)


def through(spark, rows, tmp_path, **options):
    docs = spark.createDataFrame(rows, SCHEMA)
    path = warc.deduplicate(docs, path=str(tmp_path / "w"), **options)
    records = warc.joined_revisits(warc.read_archives(spark, path))
    return path, records


def test_odd_rows(spark, tmp_path):
    rows = [
        (1, "http://a/", "<p>é\r\n\r\nWARC/1.1\r\n</p>", "x"), (2, "http://b/", "<p>é\r\n\r\nWARC/1.1\r\n</p>", "x"),
        (3, None, None, None), (4, "u\r\nInjected: 1", "", "x"), (None, "http://n/", "same", "x"),
        (5, "http://s/", "same", "x"), (5, "http://s/", "same", "x"), (None, "http://m/", "lonely", "x"),
        (6, "http://l/", "long " * 60_000, "x"),
    ]
    _, records = through(spark, rows, tmp_path)
    got = [(r.source_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
           for r in records.collect()]
    assert sorted(got, key=repr) == brute(rows)
    assert all(r.intact for r in records.filter("record_type = 'response'").collect())
    assert records.filter("target_uri LIKE '%Injected%'").first().target_uri == "u%0D%0AInjected:%201"


def test_query_on_planted_copies(spark, tmp_path):
    """Several thousand pages: a third share one payload, others come in small groups."""
    rng = random.Random(9)
    rows = []
    for page in rng.sample(range(100_000), 4_000):
        kind = rng.random()
        html = "<p>hot</p>" if kind < 0.33 else f"<p>é{rng.randrange(900)}</p>" if kind < 0.8 else f"<i>{page}</i>"
        rows.append((page, f"http://h{page % 7}.org/{page}", None if kind > 0.99 else html, None))
    spark.createDataFrame(rows, SCHEMA).drop("payload").repartition(5).write.parquet(f"{tmp_path}/pages.parquet")
    got = [tuple(r) for r in queries.op1_warc_revisits(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == brute(rows)
    assert sum(r[3] == "revisit" for r in got) > 2_000


def test_payloads_come_back_whole(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"page {i % 7} ü\r\n\r\n", "x") for i in range(50)]
    _, records = through(spark, rows, tmp_path)
    stored = {r.source_id: bytes(r.payload).decode() for r in records.collect() if r.payload is not None}
    assert len(stored) == 7
    assert all(stored[i] == f"page {i % 7} ü\r\n\r\n" for i in stored)


def test_small_payloads_are_all_responses(spark, tmp_path):
    rows = [(1, "u", "ab", ""), (2, "u", "ab", ""), (3, "u", "abcdef", ""), (4, "u", "abcdef", "")]
    _, records = through(spark, rows, tmp_path, min_bytes=3)
    got = [(r.source_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
           for r in records.collect()]
    assert sorted(got, key=repr) == brute(rows, 3)


def test_empty_table(spark, tmp_path):
    _, records = through(spark, [], tmp_path)
    assert records.count() == 0


def test_many_gzip_members():
    record = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    joined = gzip.compress(record) + gzip.compress(record)
    assert [block for _, block in warc.parse_archive(joined)] == [b"abc", b"abc"]
