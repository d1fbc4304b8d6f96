"""Jaccard self-join on word n-grams by token-combination prefixes.

A document is the set of its distinct word n-grams, as 64-bit tokens. Equal sets are one
class from the start. All tokens have one global order, rare before frequent, and a
document is indexed by its first tokens only: with k more than the sets may differ in, two
documents that link share at least k tokens of their prefixes. Prefixes are extended to
k = 2. A token of a rare class is indexed alone; of frequent classes, whose single tokens
would pair everything that holds a common passage, every combination of two in the prefix
is indexed. If the shared tokens include a rare one, the first kind finds the pair, else
two frequent ones do, so no pair is lost. Documents of more than `COMBINE_MOST` n-grams
index frequent tokens singly; the two schemes overlap by the allowed difference in size.

Token counts cover all documents: every token in the lowest quarter of the hash range is
counted exactly, every other one wherever a run of `FLUSH_TOKENS` tokens holds it more than
once, so that what is common is known as such at little cost. Those not known to be common
are ordered after the counted rare ones. The order decides the work, never the result.

Within an index entry pairs are not enumerated. Each document is first paired with two
pivots of its entry, a linear number of pairs; pairs that the prefixes alone rule out go,
the rest are verified on whole texts, and linked documents become components. Entries of many
documents that still span several components get a further pivot, drawn for each entry, so
that documents which link with many others but not with the first pivots join them now. Only
entries that still span several components are then joined with themselves, for pairs of
different components; a pair that meets in many long entries leaves one of them only. Every
link between different components is found, so components are exact.

Each set carries a sketch: for every bit, whether an odd number of its tokens falls on it.
A bit in which two sketches differ stands for at least one token that only one of the sets
has, so more such bits than a link allows rule the pair out, and never a pair that links.
The test is part of the join, so members of a large group that share most of a text without
linking leave it as no rows.

Defined results: a null text, or one without words, has an empty set and links with
nothing; a text of fewer than n words is one token of all its words; ids tell documents
apart, and rows with the same id count as one node; a document whose id is null is in its
own, null, component unless an equal set has an id. An empty table gives an empty result.
Only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import (
    few_at_a_time,
    text_blocks,
    text_or_empty,
    total_bytes,
    written,
)
from paneflow.llm.components import connected_components
from paneflow.operators.skew import broadcast_if_small

WORDS = 3
# Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 90
K = 2
# A token in more documents than this is of a frequent class.
RARE_MOST = 8
# Frequent tokens that the order knows: a fixed bound of what is broadcast.
KNOWN_FREQUENT = 1 << 20
COMBINE_MOST = 640
SKETCH_BITS = 1024
# Sets beyond this size differ in too many bits for sketches; their prefixes are compared.
SKETCHED = 2000
# Open entries of more documents than this get another pivot and compare prefixes.
CROWDED = 64
COUNT_BUCKET_BYTES = 24 << 20
FLUSH_TOKENS = 1_000_000
# Ranks: counted rare tokens, then the uncounted, then frequent ones by their count.
_LOW = np.uint64(1 << 62)
_UNCOUNTED, _FREQUENT = 1 << 60, (1 << 62) + (1 << 61)
_A, _B, _C = (np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def token_set(text: str, n: int = WORDS) -> np.ndarray:
    """Sorted distinct tokens of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(n, len(words))
    total = np.full(len(own) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        total = total * _A + own[i:len(own) - width + 1 + i] * _B + _C
    total = _mixed(total)
    total.sort()
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def least_overlap(a: Column, b: Column, percent: int) -> Column:
    """Tokens that two sets of these sizes must share to link."""
    return F.ceil((a + b) * percent / F.lit(100.0 + percent) - 1e-9)


def token_counts(texts: DataFrame, buckets: int, n: int) -> DataFrame:
    """`tokens` and `counts`, packed, of the frequent tokens of each range of tokens."""
    kept = max(1, KNOWN_FREQUENT // buckets)

    def ranges(tokens: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        distinct, count = np.unique(np.concatenate(tokens), return_counts=True)
        told = (distinct < _LOW) | (count > 1)
        # Spread the counted quarter over the whole range for even buckets.
        spread = _mixed(distinct[told])
        order = np.argsort(spread)
        distinct, count = distinct[told][order], count[told][order]
        # Equal shares of the token range; a token is in the same one in every task.
        edges = [(i << 64) // buckets for i in range(1, buckets)]
        cuts = np.searchsorted(spread[order], np.array(edges, dtype=np.uint64))
        low = np.split(distinct, cuts), np.split(count.astype(np.uint32), cuts)
        for bucket, (own, times) in enumerate(zip(*low)):
            if len(own):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int32()), pa.array([own.tobytes()], pa.binary()),
                     pa.array([times.tobytes()], pa.binary())],
                    ["bucket", "tokens", "counts"],
                )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = set(), [], 0
        for batch in few_at_a_time(batches):
            for text in batch.column(0).to_pylist():
                tokens = token_set(text, n)
                digest = hashlib.blake2b(tokens.tobytes(), digest_size=8).digest()
                if digest in seen:
                    continue
                seen.add(digest)
                held.append(tokens)
                size += len(tokens)
                if size >= FLUSH_TOKENS:
                    yield from ranges(held)
                    seen, held, size = set(), [], 0
        if held:
            yield from ranges(held)

    def add(table: pa.Table) -> pa.Table:
        tokens = np.frombuffer(b"".join(table.column("tokens").to_pylist()), dtype=np.uint64)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), dtype=np.uint32)
        distinct, at = np.unique(tokens, return_inverse=True)
        total = np.bincount(at, weights=counts).astype(np.int64)
        distinct, total = distinct[total > RARE_MOST], total[total > RARE_MOST]
        top = np.lexsort((distinct, -total))[:kept]
        return pa.table(
            {"tokens": pa.array([distinct[top].tobytes()], pa.binary()),
             "counts": pa.array([total[top].tobytes()], pa.binary())}
        )

    parts = texts.select("_text").mapInArrow(count, "bucket int, tokens binary, counts binary")
    return parts.groupBy("bucket").applyInArrow(add, "tokens binary, counts binary")


def frequent_tokens(texts: DataFrame, buckets: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The known frequent tokens, sorted, and their ranks by count."""
    rows = token_counts(texts, buckets, n).collect()
    tokens = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(bytes(r["tokens"]), np.uint64) for r in rows)])
    counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(bytes(r["counts"]), np.int64) for r in rows)])
    rank = np.empty(len(tokens), dtype=np.int64)
    rank[np.lexsort((tokens, counts))] = np.arange(len(tokens))
    order = np.argsort(tokens)
    return tokens[order], rank[order]


def ranks(tokens: np.ndarray, frequent: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Tokens as their places in the global order, ascending."""
    low = (tokens >> np.uint64(2)).astype(np.int64)
    out = np.where(tokens < _LOW, low, low + _UNCOUNTED)
    if len(frequent):
        # Both are sorted, so that neighbours are looked up near each other.
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        known = frequent[at] == tokens
        out[known] = _FREQUENT + order[at[known]]
    out.sort()
    return out


def prefix_length(size: int, percent: int, k: int = K) -> int:
    return min(size, size - -(-percent * size // 100) + k)


def sketch(tokens: np.ndarray) -> np.ndarray:
    """The parity of the number of tokens on every bit, as longs."""
    bits = ((tokens >> np.uint64(17)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = np.bincount(bits, minlength=SKETCH_BITS).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def signed_sets(
    texts: DataFrame, frequent: tuple[np.ndarray, np.ndarray], percent: int, n: int
) -> DataFrame:
    """`id`, size `n`, `digest` of the set, its `prefix` and `sketch` of every document."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)
    id_type = texts.schema["id"].dataType.simpleString()
    longs = [f"s{i}" for i in range(SKETCH_BITS // 64)]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_known, order = shared.value
        for batch in few_at_a_time(batches):
            sizes, digests, prefixes, sketches = [], [], [], []
            for text in batch.column("_text").to_pylist():
                tokens = token_set(text, n)
                sizes.append(len(tokens))
                digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                sketches.append(sketch(tokens))
                prefixes.append(
                    ranks(tokens, tokens_known, order)[:prefix_length(len(tokens), percent)]
                )
            offsets = np.cumsum([0, *map(len, prefixes)], dtype=np.int32)
            values = np.concatenate([np.zeros(0, np.int64), *prefixes])
            by_long = np.array(sketches, dtype=np.int64).reshape(-1, len(longs)).T.copy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                 pa.StructArray.from_arrays([pa.array(x) for x in by_long], longs)],
                ["id", "n", "digest", "prefix", "sketch"],
            )

    return texts.select("id", "_text").mapInArrow(
        sign,
        f"id {id_type}, n long, digest binary, prefix array<long>, "
        f"sketch struct<{', '.join(f'{x}: long' for x in longs)}>",
    )


def _pair_entry(t: Column, s: Column) -> Column:
    # Negative, apart from single tokens.
    return F.xxhash64(t, s).bitwiseOR(F.lit(-(1 << 63)))


def signatures(prefix: Column, n: Column, percent: int) -> Column:
    """Index entries of a prefix: rare tokens, and pairs or singles of frequent ones."""
    rare = F.filter(prefix, lambda t: t < _FREQUENT)
    often = F.filter(prefix, lambda t: t >= _FREQUENT)
    pairs = F.flatten(
        F.transform(
            often,
            lambda t, i: F.transform(
                F.slice(often, i + 2, F.greatest(F.size(often) - i - 1, F.lit(0))),
                lambda s: _pair_entry(t, s),
            ),
        )
    )
    none = F.slice(often, 1, 0)
    return F.concat(
        rare,
        F.when(n <= COMBINE_MOST, pairs).otherwise(none),
        F.when(n * 100 >= COMBINE_MOST * percent, often).otherwise(none),
    )


def _in_turn(*tests: Column) -> Column:
    """Whether all tests hold, each made only where those before it do. Of tests joined by
    `&` Spark makes the parts that occur twice for every row, before the first test."""
    out = tests[-1]
    for test in reversed(tests[:-1]):
        out = F.when(test, out).otherwise(F.lit(False))
    return out


def _sizes_allow(a: str, b: str, percent: int) -> Column:
    na, nb = F.col(f"{a}_n"), F.col(f"{b}_n")
    return (na * percent <= nb * 100) & (nb * percent <= na * 100)


def _sketches_allow(a: str, b: str, percent: int) -> Column:
    na, nb = F.col(f"{a}_n"), F.col(f"{b}_n")
    most = na + nb - least_overlap(na, nb, percent) * 2
    apart = [
        F.bit_count(F.col(f"{a}_sketch.s{i}").bitwiseXOR(F.col(f"{b}_sketch.s{i}")))
        for i in range(SKETCH_BITS // 64)
    ]
    # The first quarter alone rules out most pairs.
    first, rest = apart[:len(apart) // 4], apart[len(apart) // 4:]
    total = sum(first[1:], first[0])
    return _in_turn(total <= most, sum(rest, total) <= most)


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether sizes and prefixes of two sets allow a link: a token of one prefix that is
    not in the other, though the other's prefix reaches beyond it, is in one set only."""
    na, nb = F.col(f"{a}_n"), F.col(f"{b}_n")
    pa_, pb = F.col(f"{a}_prefix"), F.col(f"{b}_prefix")
    need = least_overlap(na, nb, percent)

    def only(own: Column, other: Column, size: Column) -> Column:
        beyond = F.filter(F.array_except(own, other), lambda t: t <= F.element_at(other, -1))
        return F.size(beyond) <= size - need

    return _in_turn(_sizes_allow(a, b, percent), only(pa_, pb, na), only(pb, pa_, nb))


def _meet_here(a: str, b: str, entry: str) -> Column:
    """Whether an entry is the first that two sets share: that of their least common rare
    token, else of their two least common frequent ones, else of a single frequent one."""
    common = F.array_intersect(F.col(f"{a}_prefix"), F.col(f"{b}_prefix"))
    first, second = F.get(common, F.lit(0)), F.get(common, F.lit(1))
    paired = (F.col(f"{a}_n") <= COMBINE_MOST) & (F.col(f"{b}_n") <= COMBINE_MOST)
    least = F.when((first < _FREQUENT) | ~paired, first).otherwise(_pair_entry(first, second))
    return F.col(entry) == least


def verified(pairs: DataFrame, texts: DataFrame, percent: int, n: int) -> DataFrame:
    """The pairs `a`, `b` whose whole texts link."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in few_at_a_time(batches):
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = []
            for i, node in enumerate(a):
                if node != last:
                    last, own = node, token_set(batch.column("a_text")[i].as_py(), n)
                other = token_set(batch.column("b_text")[i].as_py(), n)
                both = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(own) + len(other) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"]
            )

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text")
    return both.mapInArrow(verify, "a long, b long")


def _sized(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Distinct `a`, `b` whose sizes allow a link; only sizes are joined."""
    a = reps.select(F.col("node").alias("a"), F.col("n").alias("a_n"))
    b = reps.select(F.col("node").alias("b"), F.col("n").alias("b_n"))
    joined = pairs.distinct().join(a, "a").join(b, "b")
    return joined.filter(_sizes_allow("a", "b", percent))


def _paired(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Distinct `a`, `b` that sizes and prefixes do not rule out."""
    left = _sized(pairs, reps, percent)
    for column, allowed in (("sketch", _sketches_allow), ("prefix", _may_link)):
        a = reps.select(F.col("node").alias("a"), F.col(column).alias(f"a_{column}"))
        b = reps.select(F.col("node").alias("b"), F.col(column).alias(f"b_{column}"))
        joined = left.join(a, "a").join(b, "b").filter(allowed("a", "b", percent))
        left = joined.select("a", "b", "a_n", "b_n")
    return left.select("a", "b")


def _verified_among(pairs: DataFrame, texts: DataFrame, percent: int, n: int) -> DataFrame:
    """`verified`, having first fetched the texts of the documents in the pairs. Their ids
    are broadcast if there are few enough, else both sides are shuffled."""
    pairs = written(pairs, "pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    nodes = written(nodes, "nodes")
    asked = broadcast_if_small(nodes, nodes.count())
    own = texts.join(asked, "id", "left_semi").select(
        F.col("id").alias("node"), F.col("_text").alias("text")
    )
    return written(verified(pairs, written(own, "texts"), percent, n), "links")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    n: int = WORDS,
) -> DataFrame:
    """One row per document: `doc_id`, `n_shingles`, `component_id`."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text).alias("_text"))
    buckets = text_blocks(total_bytes(texts, "_text"), COUNT_BUCKET_BYTES)
    sets = written(signed_sets(texts, frequent_tokens(texts, buckets, n), percent, n), "sets")
    reps = written(
        sets.filter("n > 0")
        .groupBy("n", "digest")
        .agg(
            F.min("id").alias("node"),
            F.first("prefix").alias("prefix"),
            F.first("sketch").alias("sketch"),
        ),
        "representatives",
    )
    linked = _links(reps.filter("node IS NOT NULL"), texts, percent, n)
    parts = connected_components(linked)
    classes = reps.join(parts, "node", "left").select(
        "n", "digest", F.coalesce("component", "node").alias("component_id")
    )
    return sets.join(classes, ["n", "digest"], "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
    )


def _placed(shared: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postings with the `component` of their node, and the entries that span several
    components: whether `_crowded`, and a `_pivot` drawn by hash, its node and component."""
    parts = written(connected_components(links), "components")
    placed = shared.select("entry", "node").join(parts, "node", "left").select(
        "entry", "node", F.coalesce("component", "node").alias("component")
    )
    drawn = F.min_by(F.struct("node", "component"), F.xxhash64("node", "entry"))
    entries = placed.groupBy("entry").agg(
        F.min("component").alias("_low"),
        F.max("component").alias("_high"),
        (F.count(F.lit(1)) > CROWDED).alias("_crowded"),
        drawn.alias("_pivot"),
    )
    return placed, written(entries.filter("_low < _high").drop("_low", "_high"), "open_entries")


def _links(reps: DataFrame, texts: DataFrame, percent: int, n: int) -> DataFrame:
    """Verified links `a`, `b` between representatives that connect all that link."""
    postings = reps.select(
        "node", F.explode(signatures(F.col("prefix"), F.col("n"), percent)).alias("entry")
    )
    entries = postings.groupBy("entry").agg(
        F.min("node").alias("first"), F.max("node").alias("last")
    )
    shared = written(postings.join(entries.filter("first < last"), "entry"), "postings")
    to_pivots = shared.select(
        "node", F.explode(F.array("first", "last")).alias("pivot")
    ).filter("node <> pivot").select(
        F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b")
    )
    near = _verified_among(_paired(to_pivots, reps, percent), texts, percent, n)
    placed, open_entries = _placed(shared, near)
    crowded = open_entries.filter("_crowded").select("entry", "_pivot")
    if crowded.count():
        again = placed.join(crowded, "entry").filter("component <> _pivot.component").select(
            F.greatest("node", "_pivot.node").alias("a"), F.least("node", "_pivot.node").alias("b")
        )
        more = _verified_among(_paired(again, reps, percent), texts, percent, n)
        if more.count():
            near = near.unionByName(more)
            placed, open_entries = _placed(shared, near)
    # Where an entry may be long and sketches do not tell, and where many documents meet,
    # prefixes are tested in the join.
    long_entry = (F.col("n") > SKETCHED) & ((F.col("entry") < 0) | (F.col("entry") >= _FREQUENT))
    live = written(
        placed.join(open_entries.select("entry", "_crowded"), "entry")
        .join(reps.select("node", "n", "prefix", "sketch"), "node")
        .withColumn("prefix", F.when(long_entry | F.col("_crowded"), F.col("prefix")))
        .drop("_crowded"),
        "open",
    )
    held = ("node", "component", "n", "prefix", "sketch")
    a = live.select("entry", *[F.col(c).alias(f"a_{c}") for c in held])
    b = live.select(
        F.col("entry").alias("_entry"),
        *[F.col(c).alias(f"b_{c}") for c in held],
    )
    across = a.join(
        b,
        (F.col("entry") == F.col("_entry"))
        & _in_turn(
            (F.col("a_node") > F.col("b_node")) & (F.col("a_component") != F.col("b_component")),
            _sizes_allow("a", "b", percent),
            _sketches_allow("a", "b", percent),
            F.col("a_prefix").isNull()
            | F.col("b_prefix").isNull()
            | _in_turn(_meet_here("a", "b", "entry"), _may_link("a", "b", percent)),
        ),
    ).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    far = _verified_among(_paired(across, reps, percent), texts, percent, n)
    return near.unionByName(far)
