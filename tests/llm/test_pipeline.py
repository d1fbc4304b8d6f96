"""Every stage of the pipeline against a plain version of what it decides."""

import collections

import pyarrow as pa
import sentencepiece as spm
from pyspark.sql import functions as F

import corpus_pipeline as cp
from paneflow.llm import queries

SF = "/root/testdata/sf0.01"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def smallest_reachable(texts):
    """Smallest id that links of at least 0.9 lead to, found by the rarest shingles of each."""
    sets = {i: shingles(t) for i, t in texts.items()}
    often = collections.Counter(x for own in sets.values() for x in own)
    parent, index = {i: i for i in sets}, collections.defaultdict(list)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, own in sets.items():
        rare = sorted(own, key=lambda x: (often[x], x))[:len(own) // 10 + 1]
        for j in {j for x in rare for j in index[x]}:
            if 100 * len(own & sets[j]) >= 90 * len(own | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for x in rare:
            index[x].append(i)
    return {i: root(i) for i in sets}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in cp.STAGES:
        after = stage(spark, before, SF)
        if name == "sentencepiece":
            assert after.count() == before.count()
            assert after.filter("n_tokens <> size(ids)").count() == 0
            model = spm.SentencePieceProcessor(model_proto=queries.piece_model())
            texts = [r.text for r in before.collect()]
            want = collections.Counter(tuple(ids) + (model.eos_id(),) for ids in model.encode(texts))
            assert collections.Counter(tuple(r.ids) for r in after.collect()) == want
            break
        assert after.columns == list(cp.COLUMNS)
        rows, old = after.collect(), {r.doc_id: r for r in before.collect()}
        ids = collections.Counter(r.doc_id for r in rows)
        if name == "toxicity":
            assert 0.8 * len(old) < len(rows) <= len(old)
            scores = {r.doc_id: r.score for r in queries.op3_toxicity(spark, SF).collect()}
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            toxic = [i for i in labels if labels[i] == 1 and i in old]
            clean = [i for i in labels if labels[i] == 0 and i in old]
            assert sum(i in ids for i in toxic) <= 0.2 * len(toxic)
            assert sum(i in ids for i in clean) >= 0.95 * len(clean)
            # The query learns from fewer labels; both agree on nearly all documents.
            assert sum((scores[i] < cp.TOXIC) == (i in ids) for i in old) >= 0.97 * len(old)
        elif name == "exact_dedup":
            best = {}
            for r in old.values():
                best[r.text] = max(best.get(r.text, -1), r.doc_id)
            assert set(ids) == set(best.values())
        elif name == "ngram_join":
            least = smallest_reachable({i: r.text for i, r in old.items()})
            assert set(ids) == {i for i in old if least[i] == i} and set(ids) < set(old)
        if name == "mixing":
            words = lambda t: len(t.encode().split())
            total, mixed = sum(words(r.text) for r in old.values()), sum(words(r.text) for r in rows)
            assert abs(mixed - 1.5 * total) <= 20 and max(ids.values()) <= 2
            assert all(r.n_chars == len(r.text) for r in rows)
        else:
            assert max(ids.values()) == 1
            assert all(r.text == old[r.doc_id].text for r in rows)
        before = spark.createDataFrame(rows, docs.schema)


def test_odd_rows_in_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    long = " ".join(f"w{i}" for i in range(200))
    near = long.replace("w7 ", "v7 ")
    rows = [(1, long, "en", "a", 1), (2, near, "en", "a", 1), (2, "another text of the same id", "en", "a", 1),
            (3, near + " end", "en", "b", 1), (4, None, "en", None, None), (5, "", None, "b", 0), (6, "", "en", "b", 0),
            (7, long, None, None, 1), (7, long, None, None, 1), (None, "no id here", "en", "a", 1)]
    odd = spark.createDataFrame(rows, docs.schema).withColumns(
        {"shard": F.lit("mine"), "component_id": F.lit(0), "keep_id": F.lit(0), "_toxicity": F.lit("x")})
    stages = dict(cp.STAGES)

    def texts(frame):
        return sorted(((r.doc_id, r.text) for r in frame.collect()), key=str)

    for name in list(stages)[:4]:
        assert stages[name](spark, odd, SF).columns == list(cp.COLUMNS)
        assert stages[name](spark, odd.limit(0), SF).count() == 0
    deduped = stages["exact_dedup"](spark, odd, SF)
    blank = [(i, t) for i, t in texts(deduped) if not t]
    assert blank == [(6, "")]
    # Of equal texts the largest id stays; its two rows are one document.
    assert [(i, t) for i, t in texts(deduped) if t == long] == [(7, long)] * 2
    joined = texts(stages["ngram_join"](spark, odd.filter("doc_id IS NOT NULL"), SF))
    # 3 and 7 go with 1; the texts of the shared id 2 stay, as do those without words.
    assert {i for i, _ in joined} == {1, 2, 4, 5, 6} and len(joined) == 6
    mixed = stages["mixing"](spark, odd, SF)
    assert mixed.filter("text IS NULL OR text = ''").count() == 0 and mixed.filter("doc_id IS NULL").count() <= 2
    encoded = {(r.doc_id, r.n_tokens) for r in stages["sentencepiece"](spark, odd, SF).collect()}
    assert (4, 1) in encoded and (5, 1) in encoded and len(encoded) >= 8
    assert stages["sentencepiece"](spark, odd.limit(0), SF).count() == 0


def test_stages_send_small_batches(spark):
    docs = spark.createDataFrame([(i, f"text number {i}", "en", "a", 1) for i in range(3000)],
                                 "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)

    def rows_of(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    for _, stage in cp.STAGES:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        stage(spark, docs.limit(0), SF)
        sent = [r.n for r in docs.mapInArrow(rows_of, "n long").collect()]
        assert sum(sent) == 3000 and max(sent) <= 500
