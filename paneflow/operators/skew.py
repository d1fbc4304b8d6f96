"""Finding crowded groups before rows are shuffled on them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A table is broadcast only when it was counted and holds at most this many rows
# of a few longs each (some tens of MB).
BROADCAST_ROWS = 500_000
# An aggregate that gathers lists keeps so many of them at once before it turns to sorting
# (spark.sql.objectHashAggregate.sortBased.fallbackThreshold), and a task so many rows of them.
HELD_LISTS = 128
HELD_ROWS = 250_000
# Sum of the squared rows of a task's groups: what full re-fires send grows with these.
TASK_SQUARES = 20_000_000


def broadcast_if_small(table: DataFrame, n_rows: int) -> DataFrame:
    """Broadcast a counted table within the bound; otherwise leave the join to
    a shuffle that adaptive execution may split."""
    return F.broadcast(table) if n_rows <= BROADCAST_ROWS else table


@dataclass(frozen=True)
class HotGroups:
    """Keys of the groups with more rows than one task should gather."""

    table: DataFrame
    n: int
    group: tuple[str, ...]

    def only(self, rows: DataFrame) -> DataFrame:
        return rows.join(broadcast_if_small(self.table, self.n), list(self.group), "left_semi")

    def without(self, rows: DataFrame) -> DataFrame:
        return rows.join(broadcast_if_small(self.table, self.n), list(self.group), "left_anti")


def hot_groups(rows: DataFrame, group: Sequence[str], limit: int) -> HotGroups | None:
    """Groups of more than `limit` rows, or None when there are none.

    Runs one job that reads the group columns only and counts with map-side
    combine. There can be no more than (rows / limit) such groups.
    """
    table = (
        rows.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > limit)
        .select(*group)
        .persist()
    )
    n = table.count()
    if n == 0:
        table.unpersist()
        return None
    return HotGroups(table, n, tuple(group))


def hot_groups_and_tasks(
    rows: DataFrame, group: Sequence[str], limit: int
) -> tuple[HotGroups | None, int | None]:
    """`hot_groups`, and the number of tasks that are to gather the other groups.

    The number is None, which leaves it to Spark, unless the lists that a task holds
    at once could have more than `HELD_ROWS` rows, or the groups' squares are more
    than one task's share. One job when no group is hot.
    """
    n = F.col("_n")
    calm = n <= limit
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    groups, total, squares, longest, most = sizes.agg(
        F.count(F.when(calm, n)),
        F.sum(F.when(calm, n)),
        F.sum(F.when(calm, n.cast("double") * n)),
        F.max(F.when(calm, n)),
        F.max(n),
    ).first()
    hot = hot_groups(rows, group, limit) if (most or 0) > limit else None
    if not groups or (longest * HELD_LISTS <= HELD_ROWS and squares <= TASK_SQUARES):
        return hot, None
    return hot, min(groups, ceil(max(total / HELD_ROWS, squares / TASK_SQUARES)))
