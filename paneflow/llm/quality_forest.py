"""Quality rules with an isolation forest on their statistics.

1. Every whole text is read once and reduced to counts (`STATISTICS`), which are written;
   nothing later reads a text.
2. Two plain rules fail documents outright: fewer than `LEAST_WORDS` words, or more than
   `REPEATED_PERCENT` per cent of the words in repeated windows of `WINDOW` words.
3. An isolation forest judges the rest. Each of `TREES` trees splits its own
   `SUBSAMPLE` documents by random features at random places until they stand alone or the
   tree is as deep as a balanced one. A document that few splits isolate, its mean path
   being short, is anomalous: score 2 ** (-mean path / expected path), between 0 and 1.
4. The threshold comes from the labelled rows, all of them: of the scores that would reject
   at most `GOOD_LOST` of the rows labelled good, the one that rejects most of the bad ones
   beyond the share of good ones. Scores are counted per bin of `BINS`, so what reaches the
   driver has a fixed size.

The forest is fitted on at most TREES * SUBSAMPLE documents, those with the smallest hash
of id and counts among those that pass the plain rules: a bounded sample by the method's own
definition. Counts, scores, calibration and verdicts cover every row. The forest is a few
hundred KB and is broadcast.

Features are the shares of symbols, capitals and bare marks and the mean word length, with
`PRIOR` pseudo-words or pseudo-characters, so that a short text is not anomalous just because
its shares are coarse. Repeated words have their plain rule, and repeated lines come with
them; in the forest they would isolate sound texts that quote one line twice.

Defined results: a null text has no words and fails; an empty one likewise; rows that repeat
are judged alike, each on its own; a null id is a row like any other that no label is joined
to; labels that are null count for nothing, and a row that has several labels counts once
for each. Without labelled rows of both kinds there is no threshold and the forest rejects
nothing. An empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import few_at_a_time, text_or_empty, written

LEAST_WORDS = 10
WINDOW = 5
REPEATED_PERCENT = 20
TREES = 128
SUBSAMPLE = 256
SEED = 20_250_301
GOOD_LOST = 0.005
BINS = 1 << 14
PRIOR = 20.0
# Characters that the rules count as symbols.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_upper", "n_letters", "n_bare_words",
)
# Range of the hash by which the forest's documents are drawn.
_DRAWN = 1 << 40
# Kinds of characters.
_OTHER, _SPACE, _SYMBOL, _MARK, _UPPER, _LETTER = range(6)


def character_kinds() -> np.ndarray:
    """Kind of every code point: white space, symbol, other mark, capital, letter, rest."""
    kinds = np.zeros(0x110000, dtype=np.uint8)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            kinds[code] = _UPPER if c.isupper() else _LETTER
        elif not c.isalnum() and not c.isspace() and c.isprintable():
            kinds[code] = _MARK
    kinds[[ord(c) for c in SPACES]] = _SPACE
    kinds[[ord(c) for c in SYMBOLS]] = _SYMBOL
    return kinds


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of words which the text holds twice or more."""
    n = len(words)
    if n <= window:
        return 0
    numbers: dict[bytes, int] = {}
    own = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    if len(numbers) == n:
        return 0
    # Windows of two lengths add up to any other: ranks stay exact at every step.
    ranks, width = own, 1
    for _ in range(window - 1):
        longer = ranks[:-1] * np.int64(len(numbers)) + own[width:]
        ranks = np.unique(longer, return_inverse=True)[1].astype(np.int64)
        width += 1
    again = np.bincount(ranks)[ranks] > 1
    covered = np.zeros(n + 1, dtype=np.int64)
    starts = np.flatnonzero(again)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered[:n]) > 0).sum())


def statistics(text: str, kinds: np.ndarray) -> tuple[int, ...]:
    """The counts named in `STATISTICS`."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    found = kinds[codes]
    total = np.bincount(found, minlength=6).tolist()
    words = text.encode("utf-8", "surrogatepass").split()
    # Words that hold neither a letter nor anything but marks: runs between spaces.
    plain = (found != _SYMBOL) & (found != _MARK) & (found != _SPACE)
    edges = np.concatenate([[0], np.cumsum(plain)])
    space = np.concatenate([[True], found == _SPACE, [True]])
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    stops = np.flatnonzero(~space[:-1] & space[1:])
    bare = int((edges[stops] == edges[starts]).sum())
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(codes) - total[_SPACE],
        total[_SYMBOL],
        len(lines) - len(set(lines)),
        repeated_words(words),
        total[_UPPER],
        total[_UPPER] + total[_LETTER],
        bare,
    )


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, the counts of every text and `base_failed`."""
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text).alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = character_kinds()
        for batch in few_at_a_time(batches):
            rows = [statistics(t, kinds) for t in batch.column(1).to_pylist()]
            columns = np.array(rows, dtype=np.int64).reshape(-1, len(STATISTICS)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(np.ascontiguousarray(c)) for c in columns)],
                ["id", *STATISTICS],
            )

    id_type = texts.schema["id"].dataType.simpleString()
    counted = texts.mapInArrow(count, f"id {id_type}, " + ", ".join(f"{c} long" for c in STATISTICS))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")
    )
    return counted.withColumn("base_failed", failed)


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Shares that the forest splits on, one row per document."""
    c = {k: np.asarray(v, dtype=np.float64) for k, v in counts.items()}
    words = c["n_words"] + PRIOR
    return np.stack(
        [
            c["n_symbols"] / words,
            (c["word_chars"] + 5 * PRIOR) / words,
            c["n_upper"] / (c["n_letters"] + 5 * PRIOR),
            c["n_bare_words"] / words,
        ],
        axis=1,
    )


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path of an unsuccessful search in a random binary tree of n members."""
    n = np.asarray(n, dtype=np.float64)
    more = np.maximum(n, 3)
    long = 2 * (np.log(more - 1) + np.euler_gamma) - 2 * (more - 1) / more
    return np.where(n < 2, 0.0, np.where(n < 3, 1.0, long))


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: `feature` (-1 in a leaf), `split`, `left` (the right child follows
    it) and `path`, the path length that ends in a leaf. `norm` is the expected one."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    path: np.ndarray
    norm: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, split, left, path in zip(self.feature, self.split, self.left, self.path):
            node = np.zeros(len(x), dtype=np.int64)
            while True:
                own = feature[node]
                inner = own >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(own, 0)] >= split[node]
                node = np.where(inner, left[node] + right, node)
            total += path[node]
        return 2.0 ** (-total / max(len(self.feature), 1) / self.norm)


def grow(sample: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> Forest:
    """Fit a forest; each tree gets its own stretch of the sample, or, of a small sample,
    members of its own choice."""
    rng = np.random.default_rng(seed)
    own = min(subsample, len(sample))
    deepest = int(np.ceil(np.log2(max(own, 2))))
    nodes = 2 ** (deepest + 1)
    shape = (trees, nodes)
    feature, left = np.full(shape, -1, np.int64), np.zeros(shape, np.int64)
    split, path = np.zeros(shape), np.zeros(shape)
    enough = len(sample) >= trees * subsample
    for t in range(trees):
        members = (
            sample[t * own:(t + 1) * own] if enough
            else sample[rng.choice(len(sample), own, replace=False)]
        )
        todo, free = [(0, members, 0)], 1
        while todo:
            node, rows, depth = todo.pop()
            low, high = rows.min(axis=0), rows.max(axis=0)
            able = np.flatnonzero(low < high)
            if depth == deepest or len(rows) < 2 or not len(able):
                path[t, node] = depth + float(expected_path(len(rows)))
                continue
            column = int(rng.choice(able))
            at = rng.uniform(low[column], high[column])
            # The split lies above the least value, so that neither side is empty.
            at = max(at, np.nextafter(low[column], high[column]))
            right = rows[:, column] >= at
            feature[t, node], split[t, node], left[t, node] = column, at, free
            todo += [(free, rows[~right], depth + 1), (free + 1, rows[right], depth + 1)]
            free += 2
    return Forest(feature, split, left, path, max(float(expected_path(own)), 1.0))


def fit(stats: DataFrame, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> Forest | None:
    """A forest from at most trees * subsample documents that pass the plain rules; None if
    there are none."""
    drawn = F.xxhash64(F.lit(seed), F.col("id").cast("string"), *STATISTICS).bitwiseAND(F.lit(_DRAWN - 1))
    passing = stats.filter(~F.col("base_failed")).select(*STATISTICS, drawn.alias("_drawn"))
    most = trees * subsample
    # Little more than the sample is sorted: what the hash puts in front anyway.
    share = min(1.0, 1.5 * most / max(passing.count(), 1))
    sample = (
        passing.filter(F.col("_drawn") <= int(share * _DRAWN))
        .orderBy("_drawn", *STATISTICS).limit(most).drop("_drawn").toPandas()
    )
    if not len(sample):
        return None
    return grow(features({c: sample[c].to_numpy() for c in STATISTICS}), trees, subsample, seed)


def with_scores(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """Add `score`, the anomaly of every row; null without a forest."""
    if forest is None:
        return stats.withColumn("score", F.lit(None).cast("double"))
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in STATISTICS}
            score = pa.array(shared.value.scores(features(counts)))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], [*batch.schema.names, "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema)
    return stats.mapInArrow(judge, f"{fields}, score double")


def best_threshold(bins: list[tuple[int, int, int]], good_lost: float = GOOD_LOST) -> float | None:
    """Score above which documents go, from (bin, good rows, bad rows); None if no score
    rejects bad rows more than good ones."""
    good, bad = (sum(b[i] for b in bins) for i in (1, 2))
    if not good or not bad:
        return None
    best, threshold, lost, caught = 0.0, None, 0, 0
    for number, own_good, own_bad in sorted(bins, reverse=True):
        lost, caught = lost + own_good, caught + own_bad
        if lost > good_lost * good:
            break
        if caught / bad - lost / good > best:
            best, threshold = caught / bad - lost / good, number / BINS
    return threshold


def calibrate(
    scored: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality"
) -> float | None:
    """Threshold from all labelled rows (1 good, 0 bad) that pass the plain rules."""
    known = labels.filter(F.col(label).isNotNull()).select(
        F.col(id_col).alias("id"), (F.col(label) > 0).alias("_good")
    )
    good = F.col("_good").cast("long")
    bins = (
        scored.filter(~F.col("base_failed") & F.col("score").isNotNull()).select("id", "score")
        .join(known, "id")
        .groupBy(F.floor(F.col("score") * BINS).alias("bin"))
        .agg(F.sum(good).alias("good"), F.sum(1 - good).alias("bad"))
    )
    return best_threshold([(r["bin"], r["good"], r["bad"]) for r in bins.collect()])


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """Per document: its id, the counts, `base_failed`, `score` and `kept`."""
    stats = written(with_statistics(docs, id_col, text), "rule_statistics")
    scored = written(with_scores(stats, fit(stats)), "rule_scores")
    threshold = calibrate(scored, labels, id_col, label)
    # Whole bins are compared, as in the calibration.
    odd = F.lit(False) if threshold is None else (
        F.coalesce(F.floor(F.col("score") * BINS) >= threshold * BINS, F.lit(False))
    )
    return scored.withColumn("kept", ~F.col("base_failed") & ~odd).withColumnRenamed("id", id_col)
