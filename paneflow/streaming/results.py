"""The lists that fired rows stand for.

Streaming jobs send rows: `on_time`, `early` and `final` rows are the records of a list,
a `refire` row is what an allowed-late row adds, `late` and `dead_letter` rows are by
themselves. Spark gathers them here, with the batch operators, so a long list comes in parts
and a crowded window never falls to one task. The rows of a list all fire in one micro-batch,
whichever bucket or slice held them, so this works on a batch as on the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneflow.config import JobConfig
from paneflow.layout import Layout
from paneflow.operators.lateness import ALLOWED, ON_TIME
from paneflow.operators.lists import WINDOW, concat_lists, records, window_lists
from paneflow.operators.panes import late_panes, on_time_and_refires


def of_kind(fired: DataFrame, *kinds: str) -> DataFrame:
    return fired.filter(F.col("kind").isin(*kinds))


def event_time_panes(fired: DataFrame, layout: Layout, config: JobConfig) -> DataFrame:
    """On-time lists and a pane per allowed-late row: with `config.refire` "full" the whole
    list so far, with "delta" the one record. Panes are numbered in order of arrival."""
    kind = F.when(F.col("kind") == "on_time", ON_TIME).otherwise(ALLOWED)
    rows = of_kind(fired, "on_time", "refire").withColumn("status", kind).drop("kind")
    panes = on_time_and_refires(rows, layout, part_rows=config.part_rows, refire=config.refire,
                                gather_rows=config.gather_rows)
    return records(panes)


def custom_window_panes(fired: DataFrame, layout: Layout, config: JobConfig) -> DataFrame:
    """Early and final lists; a pane's number is that of its instant, counted from the start
    of the window."""
    window = (*WINDOW, "kind", "fired_at")
    rows = of_kind(fired, "early", "final")
    lists = window_lists(rows, layout, window, distinct=False, part_rows=config.part_rows)
    every = config.early_fire_ms
    instant = F.when(F.col("kind") == "final", F.col("w_end") + F.lit(every - 1)).otherwise(F.col("fired_at"))
    number = F.floor(instant / every) - F.floor(F.col("w_start") / every)
    return records(lists.withColumn("pane", number.cast("int")).drop("fired_at"))


def ingestion_lists(fired: DataFrame, layout: Layout, config: JobConfig) -> DataFrame:
    """Lists in order of arrival, copies kept."""
    lists = concat_lists(of_kind(fired, "on_time"), layout, part_rows=config.part_rows)
    return records(lists).withColumns({"pane": F.lit(0), "kind": F.lit("final")})


def late_results(fired: DataFrame, layout: Layout) -> DataFrame:
    return late_panes(of_kind(fired, "late"), layout)


def dead_letters(fired: DataFrame) -> DataFrame:
    """Reason, raw payload and origin of rows that could not be read."""
    return of_kind(fired, "dead_letter").select("dead_letter.*")
