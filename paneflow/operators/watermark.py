"""Watermarks of a recorded stream.

The watermark a row meets is the largest event time among the rows that came in
before it, less a fixed delay. That is a running maximum over the whole table in
arrival order. It is computed in levels so that no task sees the whole table:

1. rows are cut into slices that follow the arrival order;
2. each slice is reduced to its maximum (map-side combine), and the running
   maximum is taken over the small table of slices;
3. inside a slice the running maximum is a window partitioned by the slice.

A slice is a stretch of arrival time. A crowded stretch is cut further, by single
arrival milliseconds and, inside those, by ranges of the next arrival column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneflow.layout import Layout
from paneflow.operators.skew import broadcast_if_small

SLICE_MS = 3_600_000
SLICE_ROWS = 2_000_000
# Above this many slices their running maximum is itself taken in two levels.
SINGLE_LEVEL_SLICES = 100_000
_COARSE = 1_000


def _before(order: list[str], *partition: str) -> W:
    spec = W.partitionBy(*partition) if partition else W.partitionBy(F.lit(0))
    return spec.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)


def _running_slices(slices: DataFrame, n: int) -> DataFrame:
    """Add `_prev`: largest `_max` of all earlier slices. One row per slice."""
    if n <= SINGLE_LEVEL_SLICES:
        return slices.withColumn("_prev", F.max("_max").over(_before(["_slice"])))
    coarse = slices.withColumn("_coarse", F.floor(F.col("_slice") / _COARSE))
    tops = (
        coarse.groupBy("_coarse")
        .agg(F.max("_max").alias("_top"))
        .withColumn("_above", F.max("_top").over(_before(["_coarse"])))
        .drop("_top")
    )
    inner = coarse.withColumn("_in", F.max("_max").over(_before(["_slice"], "_coarse")))
    return inner.join(tops, "_coarse").withColumn(
        "_prev", F.greatest("_above", "_in")
    ).drop("_coarse", "_above", "_in")


def row_watermark(
    rows: DataFrame,
    layout: Layout,
    delay_ms: int,
    name: str = "wm",
    slice_ms: int = SLICE_MS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add the watermark each row met on arrival; null before the first one.

    Runs one small job first, which counts rows per slice to see whether any
    slice is crowded.
    """
    clock = F.col(layout.arrival[0])
    tie = layout.arrival[1] if len(layout.arrival) > 1 else None
    if tie is not None and not isinstance(rows.schema[tie].dataType, T.IntegralType):
        tie = None
    event = F.col(layout.event_ms)
    slice_col = F.floor(clock / slice_ms)

    stats = [F.count(F.lit(1)).alias("_n"), F.max(event).alias("_max")]
    if tie:
        stats += [F.min(tie).alias("_lo"), F.max(tie).alias("_hi")]
    slices = rows.groupBy(slice_col.alias("_slice")).agg(*stats).persist()
    n_slices, most = slices.agg(F.count(F.lit(1)), F.max("_n")).first()
    crowded = (most or 0) > slice_rows

    table = _running_slices(slices, n_slices)
    keep = ["_slice", "_prev"]
    if crowded:
        keep.append("_hot")
        table = table.withColumn("_hot", F.col("_n") > slice_rows)
        if tie:
            width = F.floor(
                (F.col("_hi") - F.col("_lo")) / F.ceil(F.col("_n") / slice_rows)
            ) + 1
            table = table.withColumn("_width", width)
            keep += ["_lo", "_width"]
    work = rows.withColumn("_slice", slice_col).join(
        broadcast_if_small(table.select(*keep), n_slices), "_slice"
    )

    parts = ["_slice"]
    known = [F.col("_prev")]
    helpers = list(keep)
    if crowded:
        work = work.withColumn("_ms", F.when(F.col("_hot"), clock))
        parts.append("_ms")
        if tie:
            work = work.withColumn(
                "_range",
                F.when(F.col("_hot"), F.floor((F.col(tie) - F.col("_lo")) / F.col("_width"))),
            )
            parts.append("_range")
        work = _with_finer_slices(work, parts, event)
        known.append(F.col("_fine_prev"))
        helpers += [*parts[1:], "_fine_prev"]

    inside = F.max(event).over(_before(list(layout.arrival), *parts))
    seen = _greatest([*known, inside])
    return work.withColumn(name, seen - F.lit(delay_ms).cast("long")).drop(*helpers)


def _greatest(cols: list[Column]) -> Column:
    return F.greatest(*cols) if len(cols) > 1 else cols[0]


def _with_finer_slices(work: DataFrame, parts: list[str], event: Column) -> DataFrame:
    """Add `_fine_prev`: largest event time in the earlier sub-slices of the row's
    slice. Only crowded slices have sub-slices, so the table built here covers
    those alone: the running maximum runs first over the milliseconds of a slice,
    then over the ranges of a millisecond."""
    hot = work.filter(F.col("_hot"))
    fine = hot.groupBy(*parts).agg(F.max(event).alias("_m"))
    ms = fine.groupBy("_slice", "_ms").agg(F.max("_m").alias("_mm"))
    ms = ms.withColumn("_a", F.max("_mm").over(_before(["_ms"], "_slice"))).drop("_mm")
    if "_range" in parts:
        fine = fine.withColumn("_b", F.max("_m").over(_before(["_range"], "_slice", "_ms")))
        fine = fine.join(ms, ["_slice", "_ms"])
        prev = F.greatest("_a", "_b")
    else:
        fine = ms
        prev = F.col("_a")
    fine = fine.select(*parts, prev.alias("_fine_prev"))
    # A left join on columns that are null for the other slices keeps those rows.
    return work.join(fine, parts, "left")


def batch_watermark(
    rows: DataFrame,
    layout: Layout,
    delay_ms: int,
    batch: str,
    name: str = "wm",
) -> DataFrame:
    """Add the watermark of micro-batch processing: all rows of one batch meet
    the largest event time of the batches before it, less the delay."""
    slices = (
        rows.groupBy(F.col(batch).alias("_slice"))
        .agg(F.max(layout.event_ms).alias("_max"))
        .persist()
    )
    n = slices.count()
    table = _running_slices(slices, n).select(
        F.col("_slice").alias(batch),
        (F.col("_prev") - F.lit(delay_ms).cast("long")).alias(name),
    )
    return rows.join(broadcast_if_small(table, n), batch)
