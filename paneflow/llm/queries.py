"""One query per training-data operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneflow.llm import (
    conversation_trie,
    embedding_dedup,
    exact_dedup,
    mixing,
    ngram_join,
    pii,
    pitman_yor,
    quality_forest,
    sentencepiece_codec,
    token_alignment,
    toxicity,
    url_filter,
    warc,
)
from paneflow.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = (
    url_filter.Rule("net", "/", url_filter.BLOCK),
    url_filter.Rule("example.net", "/en/", url_filter.ALLOW),
    url_filter.Rule("example.com", "/de/", url_filter.BLOCK),
    url_filter.Rule("org", "/fr/", url_filter.ALLOW),
)


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.deduplicate(read_table(spark, sf_dir, "pages"))
    records = warc.joined_revisits(warc.read_archives(spark, path, keep_payload=False))
    return records.select(
        F.col("source_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )


def piece_model() -> bytes:
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepiece_codec.encode(read_table(spark, sf_dir, "documents"), piece_model())
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def _remainder(column: str, divisor: int) -> Column:
    return F.crc32(F.col(column).cast("string")) % divisor


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").filter(_remainder("doc_id", 5) != 0)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(_remainder("doc_id", 5) == 0, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = pitman_yor.score_texts(docs, _remainder("doc_id", 7) != 2)
    return scored.select(
        "doc_id",
        (~F.col("learnt")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.tag(read_table(spark, sf_dir, "documents"))
    spans = F.col("pii")
    counts = [
        F.size(pii.of_kinds(spans, [kind])).cast("long").alias(f"n_{kind}")
        for kind in pii.BASE_KINDS
    ]
    base = pii.joined(pii.of_kinds(spans, pii.BASE_KINDS))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(base, 256).alias("base_sha256"),
        pii.joined(spans).alias("spans"),
    )


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    dealt = mixing.deal(mixing.plan_mix(docs))
    return dealt.select(
        "doc_id",
        F.col("_mix.size").alias("size"),
        F.col("_mix.source_size").alias("source_size"),
        F.col("_mix.target").alias("target"),
        mixing.taken_words().alias("taken"),
        mixing.drawing_shards().alias("shards"),
    )


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(read_table(spark, sf_dir, "documents"))


def op11_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return quality_forest.judge(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score",
    )


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.rebuilt_trie(read_table(spark, sf_dir, "conversations"))


def byte_bpe() -> str:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(read_table(spark, sf_dir, "documents"), byte_bpe(), piece_model())


QUERIES: dict[str, Query] = {
    "op1_warc_revisits": op1_warc_revisits,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_toxicity": op3_toxicity,
    "op4_pitman_yor": op4_pitman_yor,
    "op5_pii": op5_pii,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_mixing": op7_mixing,
    "op8_ngram_join": op8_ngram_join,
    "op9_url_filter": op9_url_filter,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_quality_forest": op11_quality_forest,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_token_alignment": op13_token_alignment,
}
