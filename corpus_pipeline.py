"""The corpus pipeline: five operators of `paneflow.llm` as stages over `documents`.

Every stage takes what its predecessor kept, and its result is written to the folder that
all executors share before the next one reads it.

Every stage takes null and empty texts, repeated rows and ids, and empty tables: toxicity
scores a null text as an empty one and keeps or drops all rows of equal text alike; exact
dedup keeps one null or empty text, and all rows that repeat an id and its text; the n-gram join links no text without words; the mix
takes no text without words, so the last stage has none. Columns besides those of
`documents` are left behind by the first stage.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneflow.llm import exact_dedup, mixing, ngram_join, sentencepiece_codec, toxicity
from paneflow.llm.common import read_table, text_or_empty, written
from paneflow.llm.queries import piece_model
from paneflow.operators.skew import broadcast_if_small
from paneflow.session import small_batches

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC = 0.5


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels, does not reject."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.with_score(docs, model, name="_toxicity")
    return scored.filter(F.col("_toxicity") < TOXIC).select(*COLUMNS)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_copies(docs).select(*COLUMNS)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-duplicate links connect, the one with the smallest id stays.

    An id that different texts share names neither of them: such rows all stay, and so do
    rows without an id, as no text may be lost with another's.
    """
    found = ngram_join.near_duplicates(docs)
    text = F.md5(text_or_empty())
    single = docs.groupBy(F.col("doc_id").alias("_dropped")).agg((F.min(text) == F.max(text)).alias("_one"))
    linked = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_dropped")).distinct()
    dropped = written(linked.join(single.filter("_one").select("_dropped"), "_dropped", "left_semi"), "dropped")
    dropped = broadcast_if_small(dropped, dropped.count())
    return docs.join(dropped, F.col("doc_id") == F.col("_dropped"), "left_anti").select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources; a document comes once per round in which shards draw it."""
    mixed = mixing.mix(mixing.deal(mixing.plan_mix(docs)))
    # A document at the edge of a drawn block has become shorter.
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, with the end id."""
    # Small blocks: an executor's heap has grown by the stages before.
    encoded = sentencepiece_codec.encode(
        docs, piece_model(), block_bytes=8_000_000, bucket_bytes=16 << 20
    )
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _lean(stage: Stage) -> Stage:
    """The stage in small batches: an executor keeps what its largest stage took, and all
    five run in the same ones."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(small_batches(spark), docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _lean(toxicity_stage)),
    ("exact_dedup", _lean(exact_dedup_stage)),
    ("ngram_join", _lean(ngram_join_stage)),
    ("mixing", _lean(mixing_stage)),
    ("sentencepiece", _lean(sentencepiece_stage)),
]

# A fitted classifier decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
