"""One list of records per key and window.

A list has no bound of its own, so a row of output holds at most `part_rows`
records: a window with more comes as several parts, numbered from 0, whose lists
follow one another. Windows below the bound, normally all, have the single part 0.

Which windows are crowded is counted first (`hot_groups`). Rows of all others
take one shuffle on key and window, which serves removal of copies and gathering
alike. Crowded windows are never brought to one task: copies are removed with
map-side combine under a shuffle on the full record, positions in the list are
counted level by level, and gathering runs per part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paneflow.layout import Layout
from paneflow.operators.skew import HotGroups, hot_groups

PART_ROWS = 100_000
# Longest list that one task gathers when lists are cut into parts afterwards.
GATHER_ROWS = 100_000
WINDOW = ("w_start", "w_end")
# Width of the arrival stretches in which the positions of crowded lists are counted.
STRETCH_MS = 1_000
COUNT_FIRST = object()
# Arrival field of a list element: how many marks came in with it or after it.
LEFT = "_left"


def _slim(
    rows: DataFrame, layout: Layout, group: Sequence[str], carry: Sequence[str],
    keep: Sequence[str],
) -> DataFrame:
    return rows.select(
        *group,
        F.col(layout.event_ms).alias("_ms"),
        layout.arrival_struct(*carry).alias("_at"),
        layout.record_struct().alias("_rec"),
        *keep,
    )


def _item(by_event_time: bool) -> Column:
    """List element; its leading fields are the sort order of the list."""
    ms, at = F.col("_ms").alias("ms"), F.col("_at").alias("at")
    rec = F.col("_rec").alias("rec")
    return F.struct(ms, at, rec) if by_event_time else F.struct(at, ms, rec)


def window_lists(
    rows: DataFrame,
    layout: Layout,
    window: Sequence[str] = WINDOW,
    distinct: bool = True,
    by_event_time: bool = True,
    carry: Sequence[str] = (),
    marks: Column | None = None,
    part_rows: int = PART_ROWS,
    hot: HotGroups | None | object = COUNT_FIRST,
    tasks: int | None = None,
) -> DataFrame:
    """Gather the rows of each key and window.

    distinct       keep one of several equal records, the first to arrive
    by_event_time  order by event time, ties by arrival; else by arrival
    carry          columns kept beside the arrival columns in each element; they
                   must not fall as rows arrive
    marks          also count the rows this condition holds for, copies included, as
                   `marks`, and those of them that came in with an element or after
                   it, in its `at` as `LEFT`; both null for crowded windows
    hot            result of `hot_groups` when the caller has counted already
    tasks          number of tasks that gather windows that are not crowded, by
                   default Spark's choice

    Returns the key and window columns, `part` and `items`, an array of structs
    with `ms`, `at` (arrival and carried columns) and `rec`.
    """
    group = [*layout.keys, *window]
    if hot is COUNT_FIRST:
        hot = hot_groups(rows, group, part_rows)
    slim = _slim(rows if marks is None else rows.withColumn("_mark", marks), layout, group, carry,
                 () if marks is None else ("_mark",))
    calm = slim if hot is None else hot.without(slim)
    lists = _gather(calm, group, distinct, by_event_time, marks is not None, tasks)
    if hot is None:
        return lists
    slim = hot.only(slim)
    if marks is not None:
        none = F.lit(None).cast("long")
        slim = slim.withColumn("_at", F.struct("_at.*", none.alias(LEFT))).drop("_mark")
    crowded = _gather_parts(slim, layout, group, distinct, by_event_time, part_rows)
    if marks is not None:
        crowded = crowded.withColumn("marks", none)
    return lists.unionByName(crowded)


def _gather(
    slim: DataFrame, group: list[str], distinct: bool, by_event_time: bool, marks: bool,
    tasks: int | None,
) -> DataFrame:
    columns = [F.col(c) for c in group]
    placed = slim.repartition(*columns) if tasks is None else slim.repartition(tasks, *columns)
    counted = []
    if marks:
        # Rows of equal arrival count alike, as the frame is one of values.
        later = F.sum(F.when(F.col("_mark"), 1).otherwise(0)).over(
            W.partitionBy(*group).orderBy(F.desc("_at"))
        )
        placed = placed.withColumn(LEFT, later).withColumn("_at", F.struct("_at.*", LEFT))
        # All marks came in with the first row or after it.
        counted = [F.max(f"_at.{LEFT}").alias("marks")]
    if distinct:
        placed = placed.groupBy(*group, "_ms", "_rec").agg(F.min("_at").alias("_at"))
    items = F.sort_array(F.collect_list(_item(by_event_time))).alias("items")
    part = F.lit(0).cast("long").alias("part")
    lists = placed.groupBy(*group).agg(items, *counted)
    return lists.select(*group, part, "items", *(["marks"] if marks else []))


def _gather_parts(
    slim: DataFrame,
    layout: Layout,
    group: list[str],
    distinct: bool,
    by_event_time: bool,
    part_rows: int,
) -> DataFrame:
    if distinct:
        slim = slim.groupBy(*group, "_ms", "_rec").agg(F.min("_at").alias("_at"))
    stretch = F.floor(F.col(f"_at.{layout.arrival[0]}") / STRETCH_MS)
    slim = slim.withColumn("_stretch", stretch)
    levels = ["_ms", "_stretch"] if by_event_time else ["_stretch"]
    placed = positions(slim, group, levels, ["_at"])
    return (
        placed.withColumn("part", F.floor(F.col("_pos") / part_rows))
        .groupBy(*group, "part")
        .agg(F.sort_array(F.collect_list(_item(by_event_time))).alias("items"))
    )


def positions(
    rows: DataFrame, group: list[str], levels: list[str], order: list[str], name: str = "_pos"
) -> DataFrame:
    """Position, from 0, of each row in its group under `levels` then `order`,
    without bringing a group to one task.

    Counts are taken per value of the levels with map-side combine and summed
    level by level; only the rows that agree on all levels are numbered together.
    """
    counts = rows.groupBy(*group, *levels).agg(F.count(F.lit(1)).alias("_c"))
    offsets = counts.drop("_c")
    names = []
    for depth in range(1, len(levels) + 1):
        outer, inner = levels[: depth - 1], levels[depth - 1]
        table = counts
        if depth < len(levels):
            table = counts.groupBy(*group, *levels[:depth]).agg(F.sum("_c").alias("_c"))
        before = (
            W.partitionBy(*group, *outer)
            .orderBy(inner)
            .rowsBetween(W.unboundedPreceding, -1)
        )
        names.append(f"_before{depth}")
        table = table.withColumn(
            names[-1], F.coalesce(F.sum("_c").over(before), F.lit(0).cast("long"))
        ).drop("_c")
        offsets = offsets.join(table, [*group, *levels[:depth]])
    total = F.row_number().over(W.partitionBy(*group, *levels).orderBy(*order)) - 1
    for column in names:
        total = total + F.col(column)
    return (
        rows.join(offsets, [*group, *levels])
        .withColumn(name, total)
        .drop(*names)
    )


def records(lists: DataFrame, name: str = "companies") -> DataFrame:
    """Replace the list elements by the bare records: `(key, companies)` and the
    window and part columns."""
    return lists.withColumn(name, F.transform("items", lambda x: x["rec"])).drop("items", "marks")


def wrap(rows: DataFrame, layout: Layout, *keep: str, name: str = "companies") -> DataFrame:
    """Each row as an aggregate that holds just itself."""
    return rows.select(*layout.keys, *keep, F.array(layout.record_struct()).alias(name))


def concat_lists(
    rows: DataFrame,
    layout: Layout,
    window: Sequence[str] = WINDOW,
    part_rows: int = PART_ROWS,
    hot: HotGroups | None | object = COUNT_FIRST,
) -> DataFrame:
    """Join the one-element aggregates of each key and window in arrival order,
    keeping copies."""
    return window_lists(
        rows,
        layout,
        window,
        distinct=False,
        by_event_time=False,
        part_rows=part_rows,
        hot=hot,
    )
