"""Spans against the plain patterns of the base kinds."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from paneflow.llm import pii, queries

SF = "/root/testdata/sf0.01"

NAIVE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def naive(text):
    out = []
    for kind, pattern in NAIVE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip":
                ok = all(int(p) <= 255 for p in m.group().split("."))
            elif kind == "card":
                total = 0
                for i, d in enumerate(map(int, reversed(digits))):
                    total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
                ok = 16 <= len(digits) <= 19 and total % 10 == 0
            else:
                ok = kind == "email" or 8 <= len(digits) <= 15
            if ok:
                out.append((kind, *m.span()))
    return out


def base(text):
    return [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS]


def test_random_texts_match_the_plain_patterns():
    rng = random.Random(5)
    alphabet = "a@.1@.2+-( )9é0.5%Z 4"
    for _ in range(20_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40)))
        assert base(text) == naive(text), text


def test_query_against_the_plain_patterns(spark):
    """Counts, digest and order of every document of the query."""
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op5_pii(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    found = 0
    for r in got:
        spans = naive(texts[r.doc_id])
        counts = [sum(s[0] == kind for s in spans) for kind in NAIVE]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        joined = ["%s:%d:%d" % s for s in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(r.spans.split(","))
        found += len(spans)
    assert found > 50


def test_card_numbers():
    rng = random.Random(6)
    for n in range(14, 21):
        for _ in range(60):
            digits = "".join(rng.choice("0123456789") for _ in range(n))
            text = "x " + "-".join(digits[i:i + 4] for i in range(0, n, 4)) + " y"
            assert base(text) == naive(text)


def test_iban_needs_its_checksum():
    good, bad = "DE89 3704 0044 0532 0130 00", "DE88 3704 0044 0532 0130 00"
    assert [s[:3] for s in pii.find_spans(good)] == [("iban", 0, len(good))]
    assert pii.find_spans(bad) == []


def test_account_needs_context():
    assert pii.find_spans("see 378282246310005 there") == []
    assert [s[0] for s in pii.find_spans("card 378282246310005")] == ["account"]


def test_long_runs_take_one_pass():
    text = "a" * 300_000 + "1" * 300_000 + "1." * 100_000 + "+" * 100_000
    assert pii.find_spans(text) is not None


def test_null_empty_repeated_and_extra_columns(spark):
    rows = [(1, None, "k"), (2, "", "k"), (3, "é a@b.c 1.2.3.4", "k"), (3, "é a@b.c 1.2.3.4", "k"),
            (None, "+1 (988) 555-2485", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pii string")
    got = pii.tag(docs).select("doc_id", pii.joined(F.col("pii")).alias("s")).collect()
    assert sorted((r.doc_id or 0, r.s) for r in got) == [
        (0, "phone:0:17"), (1, ""), (2, ""),
        (3, "email:2:7,ip:8:15"), (3, "email:2:7,ip:8:15"),
    ]
    assert pii.tag(docs.limit(0)).count() == 0


def test_masked(spark):
    docs = spark.createDataFrame([(1, "é a@b.c, 1.2.3.4!")], "doc_id long, text string")
    out = pii.tag(docs).join(docs, "doc_id").select(pii.masked(F.col("text"), F.col("pii")))
    assert out.first()[0] == "é [email], [ip]!"
