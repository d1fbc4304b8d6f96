"""Near-duplicate embeddings by an inverted index with product-quantised residuals.

Equal vectors of a label are collapsed first. A bounded sample gives coarse centroids and,
for the residuals, `SUBSPACES` codebooks; every vector is indexed under the centroid it is
nearest to, and a vector looks into the lists that can hold a neighbour. Two vectors at
distance d lie on sides of the bisector of their centroids that are at most d apart, and
only if they differ along the line between the centroids alone. In n dimensions the part of
a difference along a line has a spread of d / sqrt(n), so a list is probed if the bisector
is within `SPREADS` of these spreads, or within d where that is less. Up to
`SPREADS` ** 2 dimensions no link is lost; beyond, a link of just the threshold is lost if
its difference points along such a line by more than that, and closer ones more rarely.
The tests measure recall against brute force. A pair counts if each of its vectors probes
the list of the other, so links are the same seen from both.

In a list, distances come from lookup tables of the codes; a vector is passed over only if
its table distance less its own quantisation error exceeds the link distance, which loses
no link. What remains is compared by exact cosine in double precision.

Lists are cut into blocks of `BLOCK_ROWS`, queries as well, and every pair of blocks is a
task of its own, so a list with a third of all vectors is spread out. A block pair returns
numbers of links and a spanning forest of its links, never the pairs themselves.

Defined results: vectors that are null, zero, or hold null or non-finite components, and
vectors without a label, link with nothing. Vectors of different lengths do not link; every
length has an index and jobs of its own, whatever the others. Rows with the same id count
as one vector in components. A null id has a null component and is kept. Ties in the
nearest centroid go to the first. An empty table gives an empty result. Only id, vector and
label are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import written
from paneflow.llm.components import connected_components

SAMPLE = 16_384
MOST_CENTROIDS = 4096
SUBSPACES = 16
CODES = 256
BLOCK_ROWS = 2048
SEED = 17
# How far beyond a bisector lists are probed.
SPREADS = 3.0
# Room for rounding in single-precision bounds.
SLACK = 1e-4


@dataclass(frozen=True)
class Index:
    """Centroids and codebooks; `codebooks` is subspaces x codes x dimensions each."""

    centroids: np.ndarray
    codebooks: np.ndarray

    @property
    def dims(self) -> int:
        return self.centroids.shape[1]

    def nearest(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid of each row and squared distances to all."""
        square = (
            (unit**2).sum(1)[:, None] - 2 * unit @ self.centroids.T
            + (self.centroids**2).sum(1)[None, :]
        )
        return square.argmin(1), square

    def gaps(self) -> np.ndarray:
        """Distances between all centroids."""
        own = (self.centroids**2).sum(1)
        square = own[:, None] + own[None, :] - 2 * self.centroids @ self.centroids.T
        return np.sqrt(np.maximum(square, 0))

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals, and the distance between each residual and its code."""
        parts = residual.reshape(len(residual), len(self.codebooks), -1)
        codes = np.empty(parts.shape[:2], dtype=np.uint8)
        error = np.zeros(len(residual))
        for m, book in enumerate(self.codebooks):
            square = (
                (parts[:, m] ** 2).sum(1)[:, None] - 2 * parts[:, m] @ book.T
                + (book**2).sum(1)[None, :]
            )
            codes[:, m] = square.argmin(1)
            error += ((parts[:, m] - book[codes[:, m]]) ** 2).sum(1)
        return codes, np.sqrt(error)


def k_means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = points[rng.choice(len(points), size=k, replace=len(points) < k)].copy()
    for _ in range(rounds):
        square = (centres**2).sum(1)[None, :] - 2 * points @ centres.T
        own = square.argmin(1)
        count = np.bincount(own, minlength=k)
        for d in range(points.shape[1]):
            total = np.bincount(own, weights=points[:, d], minlength=k)
            centres[count > 0, d] = total[count > 0] / count[count > 0]
    return centres


def fit(sample: np.ndarray, n_vectors: int) -> Index:
    """Index for unit vectors; the number of centroids follows the table's size."""
    rng = np.random.default_rng(SEED)
    k = min(MOST_CENTROIDS, max(1, len(sample) // 16), max(1, math.isqrt(n_vectors)))
    centroids = k_means(sample, k, rng)
    index = Index(centroids, np.zeros((1, 1, sample.shape[1])))
    residual = sample - centroids[index.nearest(sample)[0]]
    subspaces = next(m for m in range(min(SUBSPACES, sample.shape[1]), 0, -1) if sample.shape[1] % m == 0)
    parts = residual.reshape(len(residual), subspaces, -1)
    books = [k_means(parts[:, m], min(CODES, len(sample)), rng, 6) for m in range(subspaces)]
    return Index(centroids, np.stack(books))


def distinct_vectors(rows: DataFrame, id_col: str, vector: str, label: str) -> DataFrame:
    """Usable vectors, one row per label and vector: `node` (smallest id), `copies`."""
    values = F.col(vector).cast("array<double>")
    usable = (
        F.col(label).isNotNull()
        & F.col(vector).isNotNull()
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )
    return (
        rows.filter(F.coalesce(usable, F.lit(False)))
        .groupBy(F.col(label).alias("label"), values.alias("vector"))
        .agg(F.min(id_col).alias("node"), F.count(F.lit(1)).alias("copies"))
    )


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by the largest component, so that no square
    overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def margin(dims: int, threshold: float) -> float:
    """How far from the bisector with another centroid its list is still probed."""
    return math.sqrt(2 - 2 * threshold) * min(1.0, SPREADS / math.sqrt(dims)) + SLACK


def probes(square: np.ndarray, cell: np.ndarray, gaps: np.ndarray, width: float) -> np.ndarray:
    """Which lists each row looks into, its own included: those whose bisector with the
    row's centroid is no farther than `width`."""
    best = square[np.arange(len(square)), cell]
    return square - best[:, None] <= 2 * width * gaps[cell] + SLACK


def placed(vectors: DataFrame, index: Index, threshold: float) -> DataFrame:
    """Rows of lists: a `member` row under the nearest centroid, its `home`, and a `query`
    row for every list it probes."""
    shared = vectors.sparkSession.sparkContext.broadcast((index.centroids, index.codebooks))
    width = margin(index.dims, threshold)
    schema = "cell int, home int, label string, member boolean, node long, copies long, vector binary, code binary, error double"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Index(*shared.value)
        gaps = own.gaps()
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                lists = part.column("vector")
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                vectors = flat.reshape(part.num_rows, own.dims)
                unit = unit_rows(vectors)
                cell, square = own.nearest(unit)
                code, error = own.encode(unit - own.centroids[cell])
                row, probe = np.nonzero(probes(square, cell, gaps, width))
                n, take = part.num_rows, pa.array(row)
                raw = pa.array([v.tobytes() for v in unit], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([cell, probe]).astype(np.int32)),
                        pa.array(np.concatenate([cell, cell[row]]).astype(np.int32)),
                        pa.concat_arrays([part.column("label"), part.column("label").take(take)]),
                        pa.array(np.arange(n + len(row)) < n),
                        pa.concat_arrays([part.column("node"), part.column("node").take(take)]),
                        pa.concat_arrays([part.column("copies"), part.column("copies").take(take)]),
                        pa.concat_arrays([raw, raw.take(take)]),
                        pa.array([c.tobytes() for c in code] + [None] * len(row), pa.binary()),
                        pa.array([*error, *[None] * len(row)], pa.float64()),
                    ],
                    [f.split(" ")[0] for f in schema.split(", ")],
                )

    columns = vectors.select(F.col("label").cast("string"), "node", "copies", "vector")
    return columns.mapInArrow(place, schema)


def in_blocks(rows: DataFrame) -> DataFrame:
    """Give every row of a list its block pairs, by the sizes of the list."""
    sizes = rows.groupBy("label", "cell").agg(
        F.ceil(F.sum(F.col("member").cast("long")) / BLOCK_ROWS).alias("m_blocks"),
        F.ceil(F.sum((~F.col("member")).cast("long")) / BLOCK_ROWS).alias("q_blocks"),
    )
    sizes = sizes.filter((F.col("m_blocks") > 0) & (F.col("q_blocks") > 0))
    mixed = F.xxhash64("node", "vector")
    sized = rows.join(sizes, ["label", "cell"])
    both = F.when(
        F.col("member"),
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("q_blocks") - 1),
            lambda q: F.struct(F.pmod(mixed, "m_blocks").alias("m"), q.alias("q")),
        ),
    ).otherwise(
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("m_blocks") - 1),
            lambda m: F.struct(m.alias("m"), F.pmod(mixed, "q_blocks").alias("q")),
        )
    )
    return sized.withColumn("block", F.explode(both)).drop("m_blocks", "q_blocks")


def table_candidates(
    index: Index, residual: np.ndarray, code: np.ndarray, error: np.ndarray, reach: float
) -> np.ndarray:
    """Which members each query may link with, by asymmetric table lookup."""
    parts = residual.reshape(len(residual), len(index.codebooks), -1)
    total = np.zeros((len(residual), len(code)), dtype=np.float32)
    for m, book in enumerate(index.codebooks):
        table = (
            (parts[:, m] ** 2).sum(1)[:, None] - 2 * parts[:, m] @ book.T + (book**2).sum(1)[None, :]
        )
        total += table.astype(np.float32)[:, code[:, m]]
    return np.sqrt(np.maximum(total, 0)) <= reach + error[None, :] + SLACK


def _forest(pairs: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Edges that connect what the pairs connect, without cycles."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent.setdefault(up, up)
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            yield a, b


def links(rows: DataFrame, index: Index, threshold: float) -> DataFrame:
    """Of every block pair: `a`, null, `n` for the rows that a's vector links with there,
    and `a`, `b`, 0 for edges of the spanning forest of its links."""
    shared = rows.sparkSession.sparkContext.broadcast((index.centroids, index.codebooks))
    reach = math.sqrt(2 - 2 * threshold) + SLACK
    width = margin(index.dims, threshold)

    def compare(block: pa.Table) -> pa.Table:
        own = Index(*shared.value)
        member = block.column("member").to_numpy()
        node = block.column("node").to_numpy()
        copies = block.column("copies").to_numpy()
        unit = np.frombuffer(
            b"".join(block.column("vector").to_pylist()), dtype=np.float64
        ).reshape(block.num_rows, own.dims)
        m, q = np.nonzero(member)[0], np.nonzero(~member)[0]
        code_column, error_column = block.column("code").to_pylist(), block.column("error").to_pylist()
        code = np.frombuffer(b"".join(code_column[i] for i in m), dtype=np.uint8).reshape(len(m), -1)
        error = np.array([error_column[i] for i in m], dtype=np.float32)
        out_a: list[int] = []
        out_b: list[int | None] = []
        out_n: list[int] = []
        edges: list[tuple[int, int]] = []
        cell = block.column("cell")[0].as_py()
        centre, home = own.centroids[cell], block.column("home").to_numpy()
        # A member answers only the queries whose own list it would probe itself.
        homes, home_of = np.unique(home[q], return_inverse=True)
        near = Index(own.centroids[np.concatenate([homes, [cell]])], own.codebooks)
        members_cell = np.full(len(m), len(homes))
        answers = probes(near.nearest(unit[m])[1], members_cell, near.gaps(), width)
        for at in range(0, len(q) if len(m) else 0, 64):
            asked = q[at:at + 64]
            maybe = table_candidates(own, unit[asked] - centre, code, error, reach)
            maybe &= answers[:, home_of[at:at + 64]].T
            i, j = np.nonzero(maybe)
            apart = node[asked[i]] != node[m[j]]
            i, j = asked[i[apart]], m[j[apart]]
            cosine = np.einsum("ij,ij->i", unit[i], unit[j])
            close = cosine >= threshold
            i, j = i[close], j[close]
            total = np.bincount(i, weights=copies[j], minlength=0)
            for row in np.unique(i):
                out_a.append(int(node[row]))
                out_b.append(None)
                out_n.append(int(total[row]))
            edges.extend(_forest(zip(node[i].tolist(), node[j].tolist())))
        for a, b in _forest(iter(edges)):
            out_a.append(a)
            out_b.append(b)
            out_n.append(0)
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64()),
                         "n": pa.array(out_n, pa.int64())})

    return rows.groupBy("label", "cell", "block").applyInArrow(compare, "a long, b long, n long")


def near_duplicates(
    rows: DataFrame,
    threshold: float = 0.93,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per input row: its id, `n_links`, `component_id`, `kept`."""
    groups = written(distinct_vectors(rows, id_col, vector, label), "vectors")
    base = rows.select(
        F.col(id_col).alias("vec_id"), F.col(label).alias("_label"),
        F.col(vector).cast("array<double>").alias("_vector"),
    )
    # One row per length of vector, of which a table has one or few.
    lengths = groups.filter("node IS NOT NULL").groupBy(F.size("vector").alias("dims")).count()
    found = rows.sparkSession.createDataFrame([], "a long, b long, n long")
    for dims, n_vectors in sorted(map(tuple, lengths.collect())):
        own = groups.filter(F.size("vector") == dims)
        found = found.unionByName(written(links_of_length(own, n_vectors, threshold), "links"))
    counts = found.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("_others"))
    parts = connected_components(found.filter("b IS NOT NULL").select("a", "b"))
    solved = (
        groups.join(counts, groups["node"] == counts["a"], "left")
        .join(parts, "node", "left")
        .select(
            "label", "vector",
            (F.coalesce("_others", F.lit(0)) + F.col("copies") - 1).alias("_links"),
            F.coalesce("component", "node").alias("_component"),
        )
    )
    same = (base["_label"] == solved["label"]) & (base["_vector"] == solved["vector"])
    joined = base.join(solved, same, "left").select(
        "vec_id",
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("_component", "vec_id")).alias("component_id"),
    )
    return joined.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def links_of_length(groups: DataFrame, n_vectors: int, threshold: float) -> DataFrame:
    """Links among distinct vectors that all have one length, through an index of theirs."""
    fitting = groups.filter(F.col("node").isNotNull())
    sample = fitting.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("vector").collect()
    index = fit(unit_rows(np.array([r["vector"] for r in sample])), n_vectors)
    return links(in_blocks(placed(fitting, index, threshold)), index, threshold)
