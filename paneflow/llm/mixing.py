"""Mixing sources to target weights by a splitting tree of exact block quotas.

Every source is a stream of its documents in a seeded random order, cut into blocks of
`block_words` words. A source's target is a number of blocks in each of up to two rounds
over its stream. A binary tree over the output shards splits the vector of all quotas:
each node gives its left half an exact share of blocks by a multivariate hypergeometric
draw, the rest goes right, down to one shard. The blocks that no quota needs are split in
the same way. So every shard has a run of the permuted blocks of each source and round to
itself, and draws its quota from the front of that run: which words the mix takes follows
from the tree, and no two shards draw the same block. Rows are shuffled within the shard
by a random key.

One row per source is on the driver, with one number more per shard. Positions in a
source's stream come from a two-level running sum: ranges of the random key are summed with
map-side combine, and rows are numbered inside their range, so that a source with a third
of all rows is spread over all tasks.

The words taken of a source are its target, rounded to a whole number: the last block drawn
is cut to what the blocks before it leave open. The words after the last whole block of a
stream belong to no shard's run; only a round that takes the whole source, or more of it
than its blocks hold, reaches them. A document whose words lie in drawn blocks only is
whole; one at the edge of a drawn block has lost the words outside. It comes once per
round, in the shard of its first drawn block. No document is taken more than twice, because
targets stop at `MOST` times their source.

Defined results: a null text has size 0 and is never taken; null is a source of its own,
ordered last; an empty table gives an empty mix; a mix of sources without any word takes
none. Rows that repeat id and text are interchangeable. A text longer than a block is drawn
block by block. Other columns stay as they are, whatever their names, but for those that
begin with `_mix`, which are dropped; `mix` replaces `shard`, `order_key`, `pass` and `words`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paneflow.llm.common import SPACE, WORD, n_words, text_or_empty, written
from paneflow.operators.skew import broadcast_if_small
from paneflow.session import shared_folder

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 4096
SHARDS = 16
SEED = 20_240_601
# Ranges of the random key, as hexadecimal digits of it.
BUCKET_DIGITS = 3


def random_key(id_col: str, text: str, seed: int) -> Column:
    """A seeded random order of documents, the same in every run."""
    parts = F.concat_ws(
        "|", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")),
        F.md5(text_or_empty(text)),
    )
    return F.md5(parts)


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """Targets of all sources from a table of `source` and `source_size`.

    Weights repeat over the sources in code-point order, null last. Targets are in
    proportion to weight, up to `MOST` times the source; what exceeds that is given to the
    others by weight. That is one water level: sources are sorted by the level at which
    they fill up, and the level is the first that leaves the next source unfilled.
    """
    order = W.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("source_rank", F.row_number().over(order) - 1)
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), F.col("source_rank") % len(weights) + 1
    )
    ranked = ranked.withColumns({"weight": weight, "cap": F.col("source_size") * MOST})
    ranked = ranked.withColumn("fills_at", F.col("cap") / F.col("weight"))
    filled = W.partitionBy(F.lit(0)).orderBy("fills_at", "source_rank").rowsBetween(
        W.unboundedPreceding, -1
    )
    every = W.partitionBy(F.lit(0))
    level = (
        F.sum("source_size").over(every) * F.lit(share)
        - F.coalesce(F.sum("cap").over(filled), F.lit(0))
    ) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(filled), F.lit(0)))
    ranked = ranked.withColumn("level", level)
    first = F.min(F.when(F.col("fills_at") >= F.col("level"), F.struct("fills_at", "source_rank", "level"))).over(every)
    ranked = ranked.withColumn("_level", first["level"])
    target = F.least(
        F.col("cap").cast("double"),
        F.coalesce(F.col("_level") * F.col("weight"), F.col("cap").cast("double")),
    )
    return ranked.withColumn("target", target).select(
        "source", "source_rank", "source_size", "target",
        F.round("target").cast("long").alias("quota_words"),
    )


def split_quotas(quotas: Sequence[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Exact quotas of blocks per shard and source, `shards` x `len(quotas)`."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    todo = [(0, shards, np.asarray(quotas, dtype=np.int64), 1)]
    while todo:
        first, last, own, node = todo.pop()
        if last - first == 1:
            out[first] = own
            continue
        middle, total = (first + last) // 2, int(own.sum())
        rng = np.random.default_rng([seed, node])
        # An exact share of blocks for the left half; a remainder goes by chance.
        exact = total * (middle - first) / (last - first)
        n_left = math.floor(exact) + int(rng.random() < exact - math.floor(exact))
        left = _hypergeometric(rng, own, n_left)
        todo.append((first, middle, left, 2 * node))
        todo.append((middle, last, own - left, 2 * node + 1))
    return out


def _hypergeometric(rng: np.random.Generator, colours: np.ndarray, n: int) -> np.ndarray:
    """Multivariate hypergeometric draw, one colour after the other."""
    drawn, rest = np.zeros_like(colours), int(colours.sum())
    for i, have in enumerate(map(int, colours)):
        if n == 0:
            break
        rest -= have
        drawn[i] = _one_colour(rng, have, rest, n)
        n -= int(drawn[i])
    return drawn


def _one_colour(rng: np.random.Generator, have: int, rest: int, n: int) -> int:
    """How many of `n` blocks drawn from `have + rest` are of the first kind.

    Beyond the range of the generator the probabilities themselves are summed, within
    twelve standard deviations of the mean; what lies outside is less than rounding.
    """
    if have == 0 or rest == 0:
        return min(have, n)
    if have + rest < 10**9:
        return int(rng.hypergeometric(have, rest, n))
    total = have + rest
    mean = n * have / total
    room = 12 * math.sqrt(mean * (rest / total) * ((total - n) / (total - 1))) + 12
    low = max(0, n - rest, math.floor(mean - room))
    high = min(n, have, math.ceil(mean + room))
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(have - k) + np.log(n - k) - np.log(k + 1) - np.log(rest - n + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    chances = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(chances, rng.random() * chances[-1], side="right"))


class Plan(NamedTuple):
    """Rows with their place in the stream of their source, and one row per source."""

    rows: DataFrame
    sources: DataFrame


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    seed: int = SEED,
) -> Plan:
    """All columns of `docs` and, under the struct `_mix`, of each row: size, source_size,
    target, rank of the source, start in its stream, random key. Beside it the sources."""
    columns = [c for c in docs.columns if not c.startswith("_mix")]
    key = random_key(id_col, text, seed)
    keyed = docs.select(
        *columns,
        F.col(source).alias("_mix_source"),
        n_words(text_or_empty(text)).alias("_mix_size"),
        key.alias("_mix_key"),
        F.substring(key, 1, BUCKET_DIGITS).alias("_mix_range"),
    )
    sums = keyed.groupBy(F.col("_mix_source").alias("source"), F.col("_mix_range").alias("range"))
    # At most 16**BUCKET_DIGITS rows per source.
    sums = written(sums.agg(F.sum("_mix_size").alias("words")), "ranges")
    sizes = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = written(source_targets(sizes, weights, share), "sources")
    before = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    ranges = ranges.join(targets, ranges["source"].eqNullSafe(targets["source"])).select(
        ranges["source"].alias("_mix_of"), F.col("range").alias("_mix_of_range"),
        F.col("before").alias("_mix_before"),
        F.struct("source_rank", "source_size", "target", "quota_words").alias("_mix_target"),
    )
    inside = W.partitionBy("_mix_source", "_mix_range").orderBy("_mix_key").rowsBetween(
        W.unboundedPreceding, -1
    )
    placed = keyed.withColumn("_mix_inside", F.coalesce(F.sum("_mix_size").over(inside), F.lit(0)))
    placed = placed.join(
        ranges,
        F.col("_mix_source").eqNullSafe(F.col("_mix_of"))
        & (F.col("_mix_range") == F.col("_mix_of_range")),
    )
    place = F.struct(
        F.col("_mix_size").alias("size"),
        *[F.col(f"_mix_target.{c}") for c in ("source_size", "target", "source_rank", "quota_words")],
        (F.col("_mix_before") + F.col("_mix_inside")).cast("long").alias("start"),
        F.col("_mix_key").alias("key"),
    )
    return Plan(placed.select(*columns, place.alias("_mix")), targets)


def round_quota(size: int, words: int, block_words: int) -> tuple[int, int, int, int]:
    """One round over a source of `size` words that takes `words`: its whole blocks, how
    many of them are drawn, words of the last one drawn, words of the stream's end."""
    whole, drawn = size // block_words, words // block_words
    if drawn >= whole:
        return whole, whole, block_words, words - whole * block_words
    last = words - drawn * block_words
    return whole, drawn + (last > 0), last or block_words, 0


def draw_recipe(
    sources: Sequence[tuple[int, int, int]], shards: int, block_words: int, seed: int
) -> list[tuple]:
    """For each rank, size and quota in words: the draws of its two rounds. A draw holds
    the permutation of blocks, of every shard the start of its run (`starts`) and the end
    of what it draws of it (`ends`), and the last block drawn with the words it gives."""
    rounds = [
        (rank, number, *round_quota(size, min(max(quota - number * size, 0), size), block_words))
        for rank, size, quota in sources
        for number in range(MOST)
    ]
    quotas = split_quotas([r[3] for r in rounds], shards, seed)
    spare = split_quotas([r[2] - r[3] for r in rounds], shards, seed + 1)
    runs = np.cumsum(quotas + spare, axis=0) - quotas - spare
    draws: dict[int, list[tuple]] = {}
    for i, (rank, number, whole, _, last_words, end_words) in enumerate(rounds):
        step, shift = _permutation(whole, seed + MOST * rank + number)
        ends = runs[:, i] + quotas[:, i]
        filled = np.nonzero(quotas[:, i])[0]
        last = int(ends[filled[-1]]) - 1 if len(filled) else -1
        draws.setdefault(rank, []).append(
            (number, whole, step, shift, runs[:, i].tolist(), ends.tolist(), last, last_words,
             end_words, (rank + number) % shards)
        )
    return list(draws.items())


DRAWS = (
    "_mix_rank int, _mix_draws array<struct<number int, whole long, step long, shift long, "
    "starts array<long>, ends array<long>, last long, last_words long, end_words long, end_shard int>>"
)


def deal(
    plan: Plan,
    shards: int = SHARDS,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Add `_mix_rounds` to the rows of the plan: for each round that takes the document its
    `pass` (0 or 1), the `words` taken, the `shard` that draws them first, and `ranges`."""
    spark = plan.rows.sparkSession
    found = plan.sources.select("source_rank", "source_size", "quota_words").collect()
    recipe = draw_recipe(sorted(map(tuple, found)), shards, block_words, seed)
    table = spark.createDataFrame(recipe, DRAWS)
    # A source's part of the table is a few numbers and two more per shard and round.
    dealt = plan.rows.join(
        broadcast_if_small(table, 2 * MOST * len(recipe) * shards),
        F.col("_mix.source_rank") == F.col("_mix_rank"),
    )
    start, size = F.col("_mix.start"), F.col("_mix.size")
    blocks = F.when(
        size > 0,
        F.sequence(
            F.floor(start / block_words).cast("long"),
            F.floor((start + size - 1) / block_words).cast("long"),
        ),
    ).otherwise(F.array().cast("array<long>"))

    def drawn(draw: Column, block: Column) -> Column:
        """What one draw takes of a block: place within the document, words, shard."""
        permuted = (block * draw["step"] + draw["shift"]) % F.greatest(draw["whole"], F.lit(1))
        shard = F.size(F.filter(draw["starts"], lambda at: at <= permuted)) - 1
        given = F.when(block >= draw["whole"], draw["end_words"]).otherwise(
            F.when(permuted >= F.get(draw["ends"], shard), 0)
            .when(permuted == draw["last"], draw["last_words"])
            .otherwise(block_words)
        )
        first = F.greatest(block * block_words, start)
        until = F.least(block * block_words + given, start + size)
        return F.struct(
            (first - start).alias("at"),
            F.greatest(until - first, F.lit(0)).cast("long").alias("words"),
            F.when(block >= draw["whole"], draw["end_shard"]).otherwise(shard).alias("shard"),
        )

    def one_round(draw: Column) -> Column:
        ranges = F.filter(
            F.transform(blocks, lambda block: drawn(draw, block)), lambda r: r["words"] > 0
        )
        return F.struct(draw["number"].alias("pass"), ranges.alias("ranges"))

    rounds = F.filter(F.transform("_mix_draws", one_round), lambda r: F.size(r["ranges"]) > 0)
    rounds = F.transform(
        rounds,
        lambda r: F.struct(
            r["pass"].alias("pass"),
            F.aggregate(r["ranges"], F.lit(0).cast("long"), lambda n, x: n + x["words"]).alias("words"),
            F.get(r["ranges"], F.lit(0))["shard"].alias("shard"),
            r["ranges"].alias("ranges"),
        ),
    )
    return dealt.withColumn("_mix_rounds", rounds).drop("_mix_rank", "_mix_draws")


def taken_words() -> Column:
    """Words that the shards draw from a row of `deal`."""
    return F.aggregate("_mix_rounds", F.lit(0).cast("long"), lambda total, r: total + r["words"])


def drawing_shards() -> Column:
    """The shards that a row of `deal` goes to, one per round that takes it."""
    return F.concat_ws(",", F.transform("_mix_rounds", lambda r: r["shard"].cast("string")))


def words_in(text: Column, ranges: Column) -> Column:
    """The words of the text that lie in the ranges, each with the space before it."""
    words = F.regexp_extract_all(text, F.lit(rf"{SPACE}*{WORD}+"), F.lit(0))
    parts = F.transform(
        ranges, lambda r: F.slice(words, (r["at"] + 1).cast("int"), r["words"].cast("int"))
    )
    return F.array_join(F.flatten(parts), "")


def mix(dealt: DataFrame, text: str = "text") -> DataFrame:
    """Rows of the mix from `deal`: a document comes once per round in which it is taken,
    with `words`, `pass`, `shard` and its `order_key` within the shard."""
    out = dealt.withColumn("_mix_round", F.explode("_mix_rounds"))
    cut = F.col("_mix_round.words") < F.col("_mix.size")
    out = out.withColumns(
        {
            text: F.when(cut, words_in(F.col(text), F.col("_mix_round.ranges"))).otherwise(F.col(text)),
            "shard": F.col("_mix_round.shard"),
            "order_key": F.md5(F.concat("_mix.key", F.col("_mix_round.pass").cast("string"))),
            "pass": F.col("_mix_round.pass"),
            "words": F.col("_mix_round.words"),
        }
    )
    return out.drop("_mix_round", "_mix_rounds", "_mix")


def _permutation(n: int, seed: int) -> tuple[int, int]:
    """Step and shift of a permutation of 0..n-1; both small enough for 64 bits."""
    rng = np.random.default_rng(seed)
    top = max(2, min(n, 2**31))
    step = int(rng.integers(1, top))
    while math.gcd(step, max(n, 1)) != 1:
        step += 1
    return step, int(rng.integers(0, top))


def write_shards(mixed: DataFrame, path: str | None = None) -> str:
    """Write the mix, one folder per shard, rows shuffled within it."""
    path = path or shared_folder(mixed.sparkSession, "mix")
    (
        mixed.repartitionByRange("shard", "order_key")
        .sortWithinPartitions("shard", "order_key")
        .write.partitionBy("shard")
        .parquet(path)
    )
    return path
