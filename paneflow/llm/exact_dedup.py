"""Exact de-duplication by content-defined chunk recipes, in DataFrame functions only.

1. Every text is cut into chunks where its content says so: after a sentence or line
   end, once a chunk has `MIN_CHUNK` characters, and at `MAX_CHUNK` at the latest.
   The cut depends on the text alone, so equal texts have equal chunks and a passage
   that many documents share falls into equal chunks in most of them.
2. Each distinct chunk is moved once per map task, to check that no two different
   chunks have the same identifier. If two have, identifiers are widened by another
   64-bit hash and checked again, until they are verified to be unique.
3. A document's recipe is the ordered list of its chunks' identifiers: some 16 bytes
   per chunk instead of the text. Documents are grouped by recipe with map-side
   combine; equal recipes of verified identifiers mean equal texts.

The recipes are written to the shared folder once; texts are never shuffled whole. The
join that takes each group's result back to its documents is a plain shuffled join whose
large partitions adaptive execution may split, so a group of copies that holds a third of
all rows needs no task of its own.

Defined results: a null text is empty, and empty texts are copies of each other; a null id
sorts below all others; rows that repeat id and text are the same document and are all
kept. An empty table gives an empty result. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import text_or_empty, written
from paneflow.operators.skew import broadcast_if_small

MIN_CHUNK, MAX_CHUNK = 1024, 16_384
# 64-bit hashes an identifier begins with.
WIDTH = 2


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """Content-defined chunks; joined they give the text back."""
    cut = rf"(?s).{{{least},{most}}}?(?<=[.!?\n])|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def seeded_hash(chunk: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), chunk)


def identifier(chunk: Column, width: int, hashed: Callable[[Column, int], Column]) -> Column:
    return F.array(*[hashed(chunk, seed) for seed in range(width)])


def ambiguous(chunk_rows: DataFrame, width: int, hashed: Callable[[Column, int], Column]) -> DataFrame:
    """Identifiers that two different chunks share; `chunk_rows` has one chunk per row."""
    table = chunk_rows.select(
        *[hashed(F.col("chunk"), seed).alias(f"_h{seed}") for seed in range(width)], "chunk"
    ).distinct()
    key = [f"_h{seed}" for seed in range(width)]
    return table.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def verified_width(
    texts: DataFrame,
    text: str,
    hashed: Callable[[Column, int], Column] = seeded_hash,
    width: int = WIDTH,
) -> int:
    """The number of hashes that tells all distinct chunks of the table apart."""
    chunk_rows = texts.select(F.explode(chunks(text_or_empty(text))).alias("chunk"))
    while not ambiguous(chunk_rows, width, hashed).isEmpty():
        width += 1
    return width


def recipes(
    docs: DataFrame,
    text: str,
    width: int,
    hashed: Callable[[Column, int], Column] = seeded_hash,
    *keep: Column | str,
) -> DataFrame:
    """`keep` columns and the `recipe` of every row."""
    parts = F.transform(
        chunks(text_or_empty(text)), lambda c: identifier(c, width, hashed)
    )
    return docs.select(*keep, F.flatten(parts).alias("recipe"))


def find_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    hashed: Callable[[Column, int], Column] = seeded_hash,
    width: int = WIDTH,
) -> DataFrame:
    """One row per input row: the id, `keep_id` (the largest id of its copies),
    `group_size`, `kept` and `text_sha256`."""
    width = verified_width(docs, text, hashed, width)
    table = written(
        recipes(
            docs,
            text,
            width,
            hashed,
            F.col(id_col).alias("doc_id"),
            F.sha2(text_or_empty(text), 256).alias("text_sha256"),
        ),
        "recipes",
    )
    groups = table.groupBy("recipe").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return table.join(groups, "recipe").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns. The list of dropped rows is
    broadcast if it is counted to be small; else both sides are shuffled on it."""
    dropped = written(
        find_copies(docs, id_col, text).filter(~F.col("kept"))
        .select(F.col("doc_id").alias("_dropped_id"), F.col("text_sha256").alias("_dropped_sha"))
        .distinct(),
        "dropped",
    )
    # An id and a digest are some 80 bytes, ten times the width the bound is meant for.
    dropped = broadcast_if_small(dropped, 10 * dropped.count())
    same = F.col(id_col).eqNullSafe(F.col("_dropped_id")) & (
        F.sha2(text_or_empty(text), 256) == F.col("_dropped_sha")
    )
    return docs.join(dropped, same, "left_anti")
