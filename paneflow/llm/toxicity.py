"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log ratios.

Features are the character n-grams (`ORDERS`) of the lower-cased text that occur in it,
hashed to `BUCKETS` slots. From labelled texts each slot gets the log ratio of its
smoothed frequencies in toxic and other texts; slots that say little (`LEAST_RATIO`) or
are seen in fewer than `LEAST_DOCS` texts get none. A logistic regression is fitted on the
features so scaled, and its weights times the ratios are the model: one table of `BUCKETS`
numbers, a fixed size, broadcast to score the whole table without a shuffle.

Training uses at most `TRAIN_DOCS` labelled texts, those with the smallest hash of their id;
their features are counted on the executors and summed by slices of the slot range, and
only the scaled features of the sample, a bounded amount, come to the driver for the fit.
Scoring takes every whole text.

Defined results: a null text is empty; an empty text has no features and gets the score of
the intercept; labels that are null are left out, and of contradicting labels of one id
toxic wins; without labelled texts of both kinds the score is the share of toxic ones, or
0 without any. Ids that are null are never learnt from and count as held out only if the
caller says so. Texts longer than `SLICE` characters are hashed slice by slice, overlapping
so that no n-gram is lost. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import text_or_empty

ORDERS = (3, 4, 5)
BUCKETS = 1 << 20
TRAIN_DOCS = 12_000
LEAST_DOCS = 4
LEAST_RATIO = 1.5
SMOOTHING = 0.5
L2 = 10.0
STEPS = 200
SLICE = 1 << 20
SLICES = 32
SAMPLE_TASKS = 16
# Odd multipliers of the polynomial hash.
_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
     0xA0761D6478BD642F], dtype=np.uint64,
)


@dataclass(frozen=True)
class Model:
    """`weights` of all slots, ratios included, and the intercept."""

    weights: np.ndarray
    intercept: float

    def score(self, text: str) -> float:
        slots, values = _present(text, self.weights)
        return float(_logistic(self.intercept + values.sum()))


def _logistic(x: np.ndarray | float) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def _hashes(codes: np.ndarray) -> np.ndarray:
    """Slots of all n-grams of a sequence of code points, repeats included."""
    out = []
    scrambled = [codes * m for m in _MULTIPLIERS]
    for n in ORDERS:
        if len(codes) < n:
            break
        total = np.zeros(len(codes) - n + 1, dtype=np.uint64)
        for i in range(n):
            total += scrambled[i][i:len(codes) - n + 1 + i]
        total ^= total >> np.uint64(29)
        total *= np.uint64(0xBF58476D1CE4E5B9 + 2 * n)
        out.append((total >> np.uint64(44)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int32)


def slots_of(text: str) -> Iterator[np.ndarray]:
    """Slots of a text's n-grams, a slice of the text at a time."""
    lowered = text.lower()
    step = SLICE - max(ORDERS) + 1
    for at in range(0, max(len(lowered), 1), step):
        part = lowered[at:at + SLICE]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        yield _hashes(codes.astype(np.uint64) + np.uint64(1))
        if at + SLICE >= len(lowered):
            return


def distinct_slots(text: str) -> np.ndarray:
    return np.unique(np.concatenate([np.unique(s) for s in slots_of(text)]))


def _present(text: str, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of a text with a weight, and the weights."""
    found = []
    for slots in slots_of(text):
        found.append(slots[weights[slots] != 0])
    distinct = np.unique(np.concatenate(found))
    return distinct, weights[distinct]


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, most: int
) -> DataFrame:
    """`toxic` and `text` of at most `most` labelled documents. The ids of the sample are
    few and bounded, so they are broadcast to the documents; the sample itself is small
    enough for a few tasks, each of which sends one table of counts."""
    known = (
        labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label).cast("int").alias("toxic"))
    )
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(most)
    found = docs.select(F.col(id_col).alias("_id"), text_or_empty(text).alias("text")).join(
        F.broadcast(chosen), "_id"
    )
    return found.repartition(SAMPLE_TASKS, "_id")


def log_ratios(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Log-count ratio of every slot, its number of texts, and the texts of both kinds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), dtype=np.int32)
        texts = [0, 0]
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[int(toxic > 0), distinct_slots(text)] += 1
                texts[int(toxic > 0)] += 1
        if not any(texts):
            return
        width = BUCKETS // SLICES
        for i in range(SLICES):
            part = seen[:, i * width:(i + 1) * width]
            yield pa.RecordBatch.from_pydict(
                {"slice": [i], "counts": [part.tobytes()], "clean": [texts[0]], "toxic": [texts[1]]},
                pa.schema([("slice", pa.int32()), ("counts", pa.binary()), ("clean", pa.int64()),
                           ("toxic", pa.int64())]),
            )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(2 * BUCKETS // SLICES, dtype=np.int64)
        for part in table.column("counts"):
            total += np.frombuffer(part.as_py(), dtype=np.int32)
        return pa.table(
            {
                "slice": table.column("slice")[:1],
                "counts": pa.array([total.tobytes()], pa.binary()),
                "clean": [sum(table.column("clean").to_pylist())],
                "toxic": [sum(table.column("toxic").to_pylist())],
            }
        )

    kinds = "slice int, counts binary, clean long, toxic long"
    parts = (
        sample.select("text", "toxic").mapInArrow(count, kinds)
        .groupBy("slice").applyInArrow(add, kinds).collect()
    )
    counts = np.zeros((2, BUCKETS))
    width = BUCKETS // SLICES
    for row in parts:
        own = np.frombuffer(bytes(row["counts"]), dtype=np.int64).reshape(2, width)
        counts[:, row["slice"] * width:(row["slice"] + 1) * width] = own
    n_clean = parts[0]["clean"] if parts else 0
    n_toxic = parts[0]["toxic"] if parts else 0
    ratio = np.log((counts[1] + SMOOTHING) / (n_toxic + 2 * SMOOTHING)) - np.log(
        (counts[0] + SMOOTHING) / (n_clean + 2 * SMOOTHING)
    )
    seen = counts.sum(axis=0)
    ratio[(seen < LEAST_DOCS) | (np.abs(ratio) < LEAST_RATIO)] = 0.0
    return ratio, seen, n_clean, n_toxic


def sample_features(sample: DataFrame, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and slots of the sample's features that have a ratio, and the labels."""
    useful = sample.sparkSession.sparkContext.broadcast(np.packbits(ratio != 0))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.unpackbits(useful.value).astype(bool)
        for batch in batches:
            slots = []
            for text in batch.column(0).to_pylist():
                own = distinct_slots(text)
                slots.append(own[keep[own]].astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots, pa.binary()), batch.column(1)], ["slots", "toxic"]
            )

    # One order in every run, so that the fit is the same.
    rows = sample.select("text", "toxic").mapInArrow(pick, "slots binary, toxic int").collect()
    rows = sorted((int(r["toxic"] > 0), bytes(r["slots"])) for r in rows)
    parts = [np.frombuffer(slots, dtype=np.int32) for _, slots in rows]
    at = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return at, np.concatenate(parts), np.array([toxic for toxic, _ in rows], dtype=float)


def fit_logistic(
    at: np.ndarray, columns: np.ndarray, values: np.ndarray, y: np.ndarray, n_columns: int
) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression on sparse rows, by gradient steps with
    running moments."""
    n = len(y)
    w = np.zeros(n_columns)
    bias = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    mean_w, moment_w, mean_b, moment_b = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    rate = 0.05
    for i in range(1, STEPS + 1):
        margin = np.bincount(at, weights=values * w[columns], minlength=n) + bias
        error = (_logistic(margin) - y) / n
        grad = np.bincount(columns, weights=values * error[at], minlength=n_columns) + L2 * w / n
        grad_b = error.sum()
        mean_w = 0.9 * mean_w + 0.1 * grad
        moment_w = 0.999 * moment_w + 0.001 * grad**2
        mean_b, moment_b = 0.9 * mean_b + 0.1 * grad_b, 0.999 * moment_b + 0.001 * grad_b**2
        one, two = 1 - 0.9**i, 1 - 0.999**i
        w -= rate * (mean_w / one) / (np.sqrt(moment_w / two) + 1e-8)
        bias -= rate * (mean_b / one) / (np.sqrt(moment_b / two) + 1e-8)
    return w, bias


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    most: int = TRAIN_DOCS,
) -> Model:
    """Fit on the documents that `labels` has a label for; the caller filters `labels`."""
    sample = labelled_sample(docs, labels, id_col, text, label, most).persist()
    try:
        ratio, _, n_clean, n_toxic = log_ratios(sample)
        weights = np.zeros(BUCKETS, dtype=np.float32)
        if not n_toxic or not n_clean:
            share = n_toxic / max(n_toxic + n_clean, 1)
            return Model(weights, 500.0 if share else -500.0)
        at, slots, y = sample_features(sample, ratio)
    finally:
        sample.unpersist()
    used, columns = np.unique(slots, return_inverse=True)
    w, bias = fit_logistic(at, columns, ratio[slots], y, len(used))
    weights[used] = w * ratio[used]
    return Model(weights, bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id and `score`, the probability that it is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))
    id_type = docs.schema[id_col].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            scores = [own.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], [id_col, "score"]
            )

    return docs.select(id_col, text_or_empty(text).alias("_text")).mapInArrow(
        scored, f"`{id_col}` {id_type}, score double"
    )


def with_score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of `docs` and the score, replacing a column of that name."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))

    @F.pandas_udf("double")
    def of(texts):
        own = Model(*shared.value)
        return texts.map(own.score)

    return docs.withColumn(name, of(text_or_empty(text)))
