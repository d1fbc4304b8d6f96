"""Lateness at its boundaries, re-fire modes, parts, hot keys, sinks, and stream against batch."""

import os
import subprocess
import sys
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from paneflow.config import JobConfig
from paneflow.functions.time import with_windows
from paneflow.layout import Layout
from paneflow.operators.lateness import with_status
from paneflow.operators.lists import concat_lists
from paneflow.operators.panes import on_time_and_refires
from paneflow.operators.skew import hot_groups_and_tasks
from paneflow.operators.watermark import row_watermark
from paneflow.plans.batch import event_time_job
from paneflow.sources.payload import parse_avro
from paneflow.streaming import results
from paneflow.streaming.jobs import event_time_stream
from paneflow.streaming.replay import Replay
from paneflow.streaming.sinks import kafka_messages

LAYOUT = Layout(("k",), "ms", ("arr", "n"), ("n", "ms"))
CONFIG = JobConfig()


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "k long, ms long, arr long, n long")


@pytest.mark.parametrize("largest, status", [(29_998, 0), (29_999, 1), (34_998, 1), (34_999, 2)])
def test_status_at_the_boundaries(spark, largest, status):
    rows = rows_of(spark, [(1, largest, 0, 0), (1, 100, 1, 1)])
    placed = with_windows(rows, "ms", CONFIG.window_ms)
    seen = with_status(row_watermark(placed, LAYOUT, CONFIG.watermark_delay_ms), CONFIG.lateness_ms)
    assert seen.filter("n = 1").first()["status"] == status


def disordered(spark):
    """Rows arrive up to 19 s after their time, some of them twice."""
    rows = [(k, i * 500, i * 500 + (i * 7919) % 19_000, i) for k in (1, 2) for i in range(240)]
    return rows_of(spark, rows + [(1, 3_500, 12_000, 7), (1, 3_500, 12_001, 7)])


def _merged(frame):
    """Records by window, pane and kind, parts put together in order."""
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.w_start, r.k, r.kind, r.pane, r.part)):
        out.setdefault((r.k, r.w_start, r.kind, r.pane), []).append((r.part, [c.n for c in r.companies]))
    return out


@pytest.mark.parametrize("mode", ["full", "delta"])
def test_parts_do_not_change_results(spark, mode):
    """Windows below and above the size bound send the same panes."""
    config = replace(CONFIG, refire=mode)
    whole = _merged(event_time_job(disordered(spark), LAYOUT, config).results)
    cut = _merged(event_time_job(disordered(spark), LAYOUT, replace(config, part_rows=3)).results)
    assert whole.keys() == cut.keys()
    for key, parts in cut.items():
        assert [p for p, _ in parts] == list(range(len(parts)))
        assert all(len(records) == 3 for _, records in parts[:-1])
        assert sum((r for _, r in parts), []) == whole[key][0][1]
    kinds = {k[2] for k in whole}
    assert kinds == {"on_time", "refire" if mode == "full" else "refire_delta"}


def test_crowded_windows_send_the_same_parts(spark):
    """Windows beyond what a task gathers, and windows cut from their lists."""
    config = replace(CONFIG, part_rows=3)
    cut = event_time_job(disordered(spark), LAYOUT, config).results
    crowded = event_time_job(disordered(spark), LAYOUT, replace(config, gather_rows=5)).results
    columns = sorted(cut.columns)
    assert sorted(map(repr, crowded.select(columns).collect())) == sorted(map(repr, cut.select(columns).collect()))


def test_small_parts_cost_no_shuffle(spark):
    """Panes hold each record once per allowed-late row: they are cut where they are made."""
    plans = [
        event_time_job(disordered(spark), LAYOUT, replace(CONFIG, part_rows=n)).results
        ._jdf.queryExecution().executedPlan().toString() for n in (100_000, 2)
    ]
    assert plans[1].count("Exchange") == plans[0].count("Exchange")


# The panes of this window's 2,000 allowed-late rows hold some 6 million records together.
MANY_PANES = """
from pyspark.sql import SparkSession, functions as F
from paneflow.config import JobConfig
from paneflow.layout import Layout
from paneflow.plans.batch import event_time_job

spark = (SparkSession.builder.master("local[1]").config("spark.driver.memory", "512m")
         .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1").getOrCreate())
layout = Layout(("k",), "ms", ("arr", "n"), ("n", "ms"))
i = F.col("id")
ms = F.when(i == 2000, 30_500).otherwise(i % 19_000)
rows = spark.range(4001).select(F.lit(1).alias("k"), ms.alias("ms"), i.alias("arr"), i.alias("n"))
panes = event_time_job(rows, layout, JobConfig()).results
print("PANES", *panes.agg(F.count("*"), F.sum(F.size("companies"))).first())
"""


def test_panes_of_a_window_pass_one_by_one():
    """A task never keeps all panes of a window, each with the window's list (1 GB here)."""
    out = subprocess.run([sys.executable, "-c", MANY_PANES], env=dict(os.environ),
                         capture_output=True, text=True, timeout=300)
    late = 2000
    records = 1 + late + sum(late + n for n in range(1, late + 1))
    assert f"PANES {2 + late} {records}" in out.stdout, out.stderr[-2000:]


@pytest.mark.parametrize("gather_rows", [100_000, 4])
def test_panes_against_a_plain_walk(spark, gather_rows):
    """Copies, rows of equal arrival, and on-time rows that come after a mark."""
    rows = [(k, (i * 37) % 50, 10 + i // 3, i % 7, i % 7, i % 2) for k in (1, 2) for i in range(40)]
    rows += [(3, i, 5, i, i, 1) for i in range(4)] + [(None, 1, None, None, 1, 1), (None, 2, 3, 1, 2, 0)]
    layout = Layout(("k",), "ms", ("arr", "n"), ("ms", "v"))
    frame = spark.createDataFrame(rows, "k long, ms long, arr long, n long, v long, status int")
    placed = with_windows(frame, "ms", 100)
    out = on_time_and_refires(placed, layout, part_rows=3, gather_rows=gather_rows)
    least = lambda x: tuple((v is not None, v or 0) for v in x)
    want = {}
    for key in {r[0] for r in rows}:
        mine, firsts = [r for r in rows if r[0] == key], {}
        for r in sorted(mine, key=lambda r: least((r[2], r[3], r[5]))):
            firsts.setdefault((r[1], r[4]), (r[1], (r[2], r[3], r[5])))
        marks = sorted(((r[2], r[3], r[5]) for r in mine if r[5] == 1), key=least)
        panes = [[x for x in firsts.values() if x[1][2] == 0]]
        panes += [[x for x in firsts.values() if least(x[1]) <= least(m)] for m in marks]
        for number, pane in enumerate(panes):
            pane.sort(key=lambda x: (x[0], least(x[1])))
            for at in range(0, len(pane), 3):
                kind = "refire" if number else "on_time"
                want[key, number, kind, at // 3] = [x[0] for x in pane[at:at + 3]]
    got = {(r.k, r.pane, r.kind, r.part): [x["ms"] for x in r["items"]] for r in out.collect()}
    assert got == want


def test_long_lists_are_gathered_in_more_tasks(spark):
    """An aggregate holds many lists at once, and panes grow with their squares."""
    rows = spark.range(600_000).selectExpr("id % 100 AS k")
    assert hot_groups_and_tasks(rows, ["k"], 10_000) == (None, 100)
    hot, tasks = hot_groups_and_tasks(rows, ["k"], 5_999)
    assert (hot.n, tasks) == (100, None)
    mixed = spark.range(600_000).selectExpr("IF(id < 2000, -1, id) AS k")
    assert hot_groups_and_tasks(mixed, ["k"], 10_000) == (None, 3)
    assert hot_groups_and_tasks(rows.limit(1_000), ["k"], 10_000) == (None, None)
    assert hot_groups_and_tasks(rows.limit(0), ["k"], 10_000) == (None, None)


def test_unknown_mode_is_refused():
    with pytest.raises(ValueError):
        JobConfig(refire="some")


def test_hot_key_in_parts(spark):
    rows = rows_of(spark, [(1, i, 5_000, i) for i in range(500)])
    lists = concat_lists(with_windows(rows, "ms", 20_000), LAYOUT, part_rows=64)
    got = [x["rec"]["n"] for r in sorted(lists.collect(), key=lambda r: r.part) for x in r["items"]]
    assert got == list(range(500))


def test_messages_tell_parts_apart(spark):
    results = event_time_job(disordered(spark), LAYOUT, replace(CONFIG, part_rows=3)).all()
    sent = kafka_messages(results, CONFIG, lambda c: F.to_json(c), lambda c: F.to_json(c))
    names = {h.key for h in sent.first().headers}
    assert {"w_start", "w_end", "part", "pane", "kind"} <= names


def test_avro_needs_a_schema(spark):
    with pytest.raises(ValueError):
        parse_avro(spark.range(1), {}, None)


def test_stream_keeps_microseconds_and_open_windows(spark, tmp_path):
    at = datetime(2024, 1, 1)
    layout = Layout(("k",), "ms", ("ms", "n"), ("stamp", "ms"))
    rows = [(k, 1_704_067_200_000 + i * 1000, i, at + timedelta(microseconds=i)) for k in (1, 2) for i in range(3)]
    rows += [(1, 1_704_067_200_000, 9, at + timedelta(microseconds=77)), (1, 1_704_067_200_000, 10, at)]
    frame = spark.createDataFrame(rows, "k long, ms long, n long, stamp timestamp_ntz")
    run = Replay(spark, frame.schema, lambda r: event_time_stream(r, layout, CONFIG), str(tmp_path))
    run.feed(frame)
    run.drain(layout, 1_704_067_202_000, 60_000)
    run.stop()
    out = results.event_time_panes(run.results(), layout, CONFIG)
    got = {r.k: [c.stamp.microsecond for c in r.companies] for r in out.collect()}
    assert got == {1: [0, 77, 1, 2], 2: [0, 1, 2]}
    batch = event_time_job(frame, layout, CONFIG).results
    assert {r.k: [c.stamp.microsecond for c in r.companies] for r in batch.collect()} == got
