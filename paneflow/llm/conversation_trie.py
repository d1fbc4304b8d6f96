"""Conversation prefix trie by collapsing whole sequences.

A node of the trie is a distinct opening of conversations, a sequence of the first d turns
(role and text). Its members are the conversations that start with it.

1. Turns shrink to a digest and a word count before the first shuffle; texts never move.
2. Identical conversations collapse into one weighted sequence with a list of its ends.
   Only the representative of a sequence, its smallest conversation, keeps its turns.
3. Sequences that are proper prefixes of others are dropped by an anti-join; those that
   remain are the leaves.
4. The prefixes of all sequences are aggregated with their weights, map-side first.

The opening of depth d is identified by the depth and by the exclusive or of 120-bit
hashes of (position, digest) of its turns. Such a key is a running aggregate, so that a
conversation of any length is cut into stretches (`STRETCH` turns) and put together from
stretch totals. Positions are counted the same way, over ranges of a global sort. No task
gathers a conversation, a group of copies or the members of a node.

`saved_tokens` of a node sums (members - 1) * words over its subtree. Every node is owned
by the representative that gives it its name, so the sum over a subtree is the sum, over the
sequences that pass the node, of what their own turns from there on count for: weight times
words, less the words of nodes they own. That is one suffix sum per sequence, linear in the
turns however deep the trie.

Defined results: rows whose conversation is null belong to none and are left out; a null
role or text is empty; turns go by turn number, null first, then by role and by the MD5 of
the text, so repeated rows are turns of their own, one after the other; a conversation
without turns ends at the root; an empty table gives no node. Other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paneflow.llm.common import n_words, text_or_empty, written

# Turns of a conversation whose running values are computed together.
STRETCH = 4096
# Ids of one group of copies that travel as one row.
ENDS_PER_ROW = 50_000
KEY = ("depth", "ka", "kb")

# Shared openings: conversations of one block of ids start with turns of its first one.
BLOCK_IDS = 20
OPENINGS = 4


def numbered_turns(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """`conv`, `pos` from 1 on, `digest` and `words` of every turn."""
    said, by = text_or_empty(text), text_or_empty(role)
    slim = rows.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        by.alias("role"),
        F.md5(said).alias("text_md5"),
        F.md5(F.concat_ws(":", F.length(by), by, said)).alias("digest"),
        n_words(said).alias("words"),
        F.monotonically_increasing_id().alias("tie"),
    )
    order = ["turn", "role", "text_md5", "tie"]
    slim = written(slim, "turns")
    # A global sort cuts long conversations; their parts follow one another by number.
    ranged = slim.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "ranged_turns")
    earlier = W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = ranged.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = F.row_number().over(W.partitionBy("conv", "part").orderBy(*order))
    return (
        ranged.withColumn("inside", inside)
        .join(parts, ["conv", "part"])
        .select("conv", (F.col("before") + F.col("inside")).alias("pos"), "digest", "words")
    )


def with_shared_openings(
    turns: DataFrame, block_ids: int = BLOCK_IDS, openings: int = OPENINGS
) -> tuple[DataFrame, DataFrame]:
    """Rebuild conversations: the first h turns of c are those of the first conversation of
    its block of ids, c - c % `block_ids`, as far as it has them; c's own turns after its
    first h follow. h is the CRC-32 of c in decimals modulo `openings`. For a negative c the
    remainder has c's sign, as in SQL.

    Gives the rebuilt turns and one row, `conv`, per conversation, also of those that are
    left without turns.
    """
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    convs = convs.withColumns(
        {
            "first": F.col("conv") - F.col("conv") % block_ids,
            "h": F.crc32(F.col("conv").cast("string")) % openings,
        }
    )
    has = convs.select(F.col("conv").alias("first"), F.col("n").alias("has"))
    convs = convs.join(has, "first", "left").withColumn(
        "taken", F.least("h", F.coalesce("has", F.lit(0)))
    )
    convs = written(convs.select("conv", "first", "h", "taken"), "conversations")
    own = turns.join(convs.select("conv", "h", "taken"), "conv").filter("pos > h")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "words")
    heads = turns.filter(F.col("pos") < openings).withColumnRenamed("conv", "first")
    opened = convs.filter("taken > 0").join(heads, "first").filter("pos <= taken")
    return own.unionByName(opened.select("conv", "pos", "digest", "words")), convs.select("conv")


def _half(hexadecimal: Column, at: int) -> Column:
    return F.conv(F.substring(hexadecimal, at, 15), 16, 10).cast("long")


def _running(rows: DataFrame, value: Column, name: str, total, backwards: bool = False) -> DataFrame:
    """Add the running `total` (an aggregate) of `value` along each conversation, the row
    itself included: inside stretches, and over the totals of the stretches before."""
    way = (lambda c: F.col(c).desc()) if backwards else F.col
    frame = W.unboundedPreceding
    inside = W.partitionBy("conv", "_stretch").orderBy(way("depth")).rowsBetween(frame, W.currentRow)
    before = W.partitionBy("conv").orderBy(way("_stretch")).rowsBetween(frame, -1)
    rows = rows.withColumns({"_stretch": F.floor(F.col("depth") / STRETCH), "_value": value})
    stretches = rows.groupBy("conv", "_stretch").agg(total("_value").alias("_total"))
    stretches = stretches.withColumn("_before", total("_total").over(before)).drop("_total")
    rows = rows.withColumn("_inside", total("_value").over(inside)).join(stretches, ["conv", "_stretch"])
    both = total.combine(F.col("_inside"), F.coalesce("_before", F.lit(0)))
    return rows.withColumn(name, both).drop("_stretch", "_value", "_inside", "_before")


class _Xor:
    def __call__(self, column: str) -> Column:
        return F.bit_xor(column)

    def combine(self, a: Column, b: Column) -> Column:
        return a.bitwiseXOR(b.cast("long"))


class _Sum:
    def __call__(self, column: str) -> Column:
        return F.sum(column)

    def combine(self, a: Column, b: Column) -> Column:
        return a + b


def keyed_turns(turns: DataFrame) -> DataFrame:
    """`conv`, `depth`, the halves `ka`, `kb` of the key of the opening that ends with the
    turn, the halves `a`, `b` of the turn's own hash, `words`."""
    own = F.md5(F.concat_ws(":", F.col("pos"), F.col("digest")))
    hashed = turns.select(
        "conv", F.col("pos").cast("long").alias("depth"), "words", own.alias("_own")
    ).select("conv", "depth", "words", _half(F.col("_own"), 1).alias("a"), _half(F.col("_own"), 17).alias("b"))
    for half in ("a", "b"):
        hashed = _running(hashed, F.col(half), f"k{half}", _Xor())
    return hashed


def collapsed(keyed: DataFrame, convs: DataFrame) -> DataFrame:
    """Every conversation with the key of its whole sequence."""
    whole = keyed.groupBy("conv").agg(
        F.count(F.lit(1)).alias("depth"), F.bit_xor("a").alias("ka"), F.bit_xor("b").alias("kb")
    )
    return convs.join(whole, "conv", "left").select(
        "conv", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in KEY]
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int, int], int, int]]:
    """Runs of rows with one key: the key, first row, row after the last."""
    if not batch.num_rows:
        return
    parts = [np.asarray(batch.column(c)) for c in KEY]
    changed = np.zeros(batch.num_rows, dtype=bool)
    changed[0] = True
    for part in parts:
        changed[1:] |= part[1:] != part[:-1]
    starts = np.flatnonzero(changed)
    for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
        yield tuple(int(p[start]) for p in parts), start, stop


def _columns(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


_LONGS = [pa.int64()] * 3


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the lists of ends, ids in order, as text."""
    for batch in batches:
        ids = batch.column("conv").to_pylist()
        rows = [
            (*key, ids[at], ",".join(map(str, ids[at:min(at + ENDS_PER_ROW, stop)])))
            for key, start, stop in _runs(batch)
            for at in range(start, stop, ENDS_PER_ROW)
        ]
        yield _columns(rows, [*KEY, "first", "ids"], [*_LONGS, pa.int64(), pa.string()])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's pieces, which follow one another; only the state is held."""
    held, state = None, None
    for batch in batches:
        ids, rows = batch.column("ids").to_pylist(), []
        for key, start, stop in _runs(batch):
            if key != held:
                if held is not None:
                    rows.append((*held, state.hexdigest()))
                held, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(",".join(ids[start:stop]).encode())
        yield _columns(rows, [*KEY, "ends_sha256"], [*_LONGS, pa.string()])
    if held is not None:
        yield _columns([(*held, state.hexdigest())], [*KEY, "ends_sha256"], [*_LONGS, pa.string()])


def end_lists(members: DataFrame) -> DataFrame:
    """`ends_sha256` per key: SHA-256 of the members' ids in decimals, ascending, joined by
    commas. A large group is cut by a global sort and travels on as a few long pieces; the
    task that hashes it holds one batch of them."""
    keys = ", ".join(f"{c} long" for c in KEY)
    pieces = (
        members.select(*KEY, "conv")
        .repartitionByRange(*KEY, "conv")
        .sortWithinPartitions(*KEY, "conv")
        .mapInArrow(_joined_ids, f"{keys}, first long, ids string")
    )
    return (
        pieces.repartition(*KEY)
        .sortWithinPartitions(*KEY, "first")
        .mapInArrow(_digests, f"{keys}, ends_sha256 string")
    )


def prefix_nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of `turns` (`conv`, `pos`, `digest`, `words`) of `convs`: conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    keyed = written(keyed_turns(turns), "keyed_turns")
    members = written(collapsed(keyed, convs), "members")
    sequences = members.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("weight"), F.min("conv").alias("conv")
    )
    sequences = written(sequences, "sequences")
    parent = {"pa": F.col("ka").bitwiseXOR(F.col("a")), "pb": F.col("kb").bitwiseXOR(F.col("b"))}
    prefixes = keyed.join(sequences.select("conv", "weight"), "conv").withColumns(parent).drop("a", "b")
    prefixes = written(prefixes, "prefixes")

    inner = prefixes.select((F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"))
    inner = written(inner.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_passing")).drop("_passing"), "inner")
    leaves = sequences.join(inner, list(KEY), "left_anti").select("conv", F.lit(1).alias("leaf"))

    owners = written(prefixes.groupBy(*KEY).agg(F.min("conv").alias("conv_id")), "owners")
    counted = prefixes.join(owners, list(KEY)).join(leaves, "conv", "left")
    owned = (F.col("conv") == F.col("conv_id")).cast("long")
    saved = (F.col("weight") - owned) * F.col("words")
    counted = _running(counted, saved, "saved", _Sum(), backwards=True)
    # Every sequence also passes the root, where it counts for all of its turns.
    totals = counted.filter("depth = 1").select("conv", "saved")
    none = F.lit(None).cast("long")
    root = (
        sequences.select("conv", "weight").join(leaves, "conv", "left").join(totals, "conv", "left")
        .select(
            F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("ka"),
            F.lit(0).cast("long").alias("kb"), none.alias("pa"), none.alias("pb"),
            "conv", "weight", "leaf", "saved",
        )
    )
    passing = counted.select(*KEY, "pa", "pb", "conv", "weight", "leaf", "saved").unionByName(root)
    nodes = written(
        passing.groupBy(*KEY).agg(
            F.min("conv").alias("conv_id"),
            F.sum("weight").alias("n_convs"),
            F.coalesce(F.sum("leaf"), F.lit(0)).cast("long").alias("n_leaves"),
            F.coalesce(F.sum("saved"), F.lit(0)).cast("long").alias("saved_tokens"),
            F.max("pa").alias("pa"),
            F.max("pb").alias("pb"),
        ),
        "nodes",
    )
    up = [(F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb")]
    children = nodes.filter("depth > 0").select(*up).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("ka").alias("pa"), F.col("kb").alias("pb"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    no_ends = hashlib.sha256().hexdigest()
    return (
        nodes.join(children, list(KEY), "left")
        .join(end_lists(members), list(KEY), "left")
        .join(above, ["depth", "pa", "pb"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(no_ends)).alias("ends_sha256"),
        )
    )


def rebuilt_trie(rows: DataFrame, **columns: str) -> DataFrame:
    """The trie of the conversations of a table of turns, rebuilt with shared openings."""
    turns = written(numbered_turns(rows, **columns), "numbered_turns")
    rebuilt, convs = with_shared_openings(turns)
    return prefix_nodes(written(rebuilt, "rebuilt_turns"), convs)
