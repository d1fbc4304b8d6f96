"""Connected components of a graph given by its edges, by alternating star operations.

Each round points every node's larger neighbours at its smallest neighbour, then every
node and its smaller neighbours at the smallest of them, until nothing changes: all
edges then lead from a node to the smallest node of its component. The edges of a round
are written to the shared folder, so lineage stays short; a node with many edges is
pre-aggregated before the shuffle and its join can be split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import written

MOST_ROUNDS = 60


def _towards_least(edges: DataFrame, keep_larger: bool) -> DataFrame:
    """`u`, `v` pairs pointed at the smallest neighbour of `u`, itself included."""
    least = edges.groupBy("u").agg(F.min("v").alias("_min"))
    least = least.select("u", F.least("u", "_min").alias("m"))
    joined = edges.join(least, "u")
    if keep_larger:
        moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.filter("u > v").distinct()
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    itself = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(itself).filter("u > v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """`node` and `component`, the smallest node reachable, for every node that has an
    edge to another. `edges` has long columns `a` and `b`; order and repeats do not
    matter, rows with a null or with a = b count for nothing."""
    own = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    own = edges.sparkSession.createDataFrame([], "u long, v long").unionByName(
        own.filter("u > v").select("u", "v").distinct()
    )
    own = written(own, "edges")
    before = None
    for _ in range(MOST_ROUNDS):
        state = own.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).first()
        if state == before:
            return own.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                own.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
        both = own.unionByName(own.select(F.col("v").alias("u"), F.col("u").alias("v")))
        own = written(_towards_least(_towards_least(both, True), False), "edges")
    raise RuntimeError("the components did not settle")
