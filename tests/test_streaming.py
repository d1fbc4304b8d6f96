"""The running jobs: restarts, redelivery, hot keys, purge, dead letters, sinks, sources."""

import hashlib
import time
from dataclasses import replace

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneflow.config import JobConfig
from paneflow.functions.time import TimeDomain
from paneflow.layout import Layout
from paneflow.sources.kafka import registry_frame, registry_payload
from paneflow.sources.payload import company_columns, decode_registry, parse_company_json, split_valid
from paneflow.sources.synthetic import synthetic_stream
from paneflow.streaming import results
from paneflow.streaming.jobs import custom_window_stream, event_time_stream, ingestion_time_stream, prepare
from paneflow.streaming.processors import LatenessProcessor
from paneflow.streaming.replay import Replay
from paneflow.streaming.sinks import LateCounter, result_messages, start_messages, start_results
from paneflow.streaming.table import ResultTable

BASE = 1_704_067_200_000
LAYOUT = Layout(("k",), "ms", ("arr", "n"), ("n", "ms"))
CONFIG = JobConfig(buckets=2)
SCHEMA = "k long, ms long, arr long, n long"


def rows_of(spark, rows):
    """Rows of (key, seconds, number), arriving in the order of their numbers."""
    return spark.createDataFrame([(k, BASE + int(s * 1000), n, n) for k, s, n in rows], SCHEMA).coalesce(1)


def event_run(spark, path, config=CONFIG):
    schema = T.StructType.fromDDL(SCHEMA)
    return Replay(spark, schema, lambda r: event_time_stream(r, LAYOUT, config), str(path))


BATCHES = [
    [(1, 1, 0), (1, 5, 1), (2, 3, 2), (1, 25, 3)],
    [(1, 31, 4), (2, 2, 5)],
    # The watermark is at 21 s: of the window [0, 20) rows are allowed late until 25 s.
    [(1, 7, 6), (1, 5, 1), (2, 33, 7), (1, 36, 8)],
    [(1, 4, 9), (2, 26, 10)],
    [(1, 80, 11)],
]


def shown(frame):
    return sorted((r.k, r.w_start - BASE, r.kind, r.pane, [c.n for c in r.companies]) for r in frame.collect())


def panes(run, config=CONFIG):
    rows = run.results()
    return shown(results.event_time_panes(rows, LAYOUT, config).unionByName(results.late_results(rows, LAYOUT)))


WANTED = sorted([
    (1, 0, "on_time", 0, [0, 1]), (2, 0, "on_time", 0, [2, 5][::-1]),
    (1, 0, "refire", 1, [0, 1]), (1, 0, "refire", 2, [0, 1, 6]), (1, 0, "late", 0, [9]),
    (1, 20_000, "on_time", 0, [3, 4, 8]), (2, 20_000, "on_time", 0, [10, 7]),
])


@pytest.mark.parametrize("restarts", [False, True])
def test_fires_are_the_same_over_restarts(spark, tmp_path, restarts):
    counter, ids = LateCounter(), set()
    spark.streams.addListener(counter)
    try:
        run = event_run(spark, tmp_path)
        for batch in BATCHES:
            run.feed(rows_of(spark, batch))
            ids.add(str(run.query.id))
            if restarts:
                run.stop()
                assert counter.wait(str(run.query.runId))
                run = event_run(spark, tmp_path)
        run.stop()
        if run.query is not None:
            assert counter.wait(str(run.query.runId))
    finally:
        spark.streams.removeListener(counter)
    assert panes(run) == WANTED
    deltas = [r for r in panes(run, replace(CONFIG, refire="delta")) if r[2] == "refire_delta"]
    assert [r[3:] for r in deltas] == [(1, [1]), (2, [6])]
    fresh = {r.n: r.fresh for r in results.of_kind(run.results(), "refire").collect()}
    assert fresh == {1: False, 6: True}
    assert len(ids) == 1 and counter.of(ids.pop()) == counter.total == 1


def test_a_failed_batch_is_run_again(spark, tmp_path):
    prepare(spark)
    rows_of(spark, BATCHES[0]).write.parquet(str(tmp_path / "input"))
    table, failed = ResultTable(str(tmp_path / "table")), []

    class Failing:
        def write(self, batch, batch_id):
            table.write(batch, batch_id)
            if batch_id == 0 and not failed:
                failed.append(True)
                raise OSError("lost")

    source = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "input"))
    out = event_time_stream(source, LAYOUT, CONFIG)
    with pytest.raises(Exception, match="lost"):
        start_results(out, Failing(), str(tmp_path / "checkpoint"), once=True).awaitTermination()
    for batch in (BATCHES[1], [(1, 80, 11)]):
        rows_of(spark, batch).write.mode("append").parquet(str(tmp_path / "input"))
        start_results(out, Failing(), str(tmp_path / "checkpoint"), once=True).awaitTermination()
    got = shown(results.event_time_panes(table.read(spark, out.schema), LAYOUT, CONFIG))
    assert got == [(1, 0, "on_time", 0, [0, 1]), (1, 20_000, "on_time", 0, [3, 4]), (2, 0, "on_time", 0, [5, 2])]


def state_rows(run):
    return run.query.lastProgress.stateOperators[0].numRowsTotal


def test_redelivery_leaves_the_state_as_it_is_and_closing_empties_it(spark, tmp_path):
    run = event_run(spark, tmp_path)
    rows = rows_of(spark, [(k, k / 10, k) for k in range(100)])
    run.feed(rows)
    before = state_rows(run)
    for _ in range(2):
        run.feed(rows)
        assert state_rows(run) == before
    run.drain(LAYOUT, BASE + 10_000, 60_000)
    # One window is open, that of the row that closed the others.
    alone = state_rows(run)
    run.stop()
    other = event_run(spark, tmp_path / "other")
    other.feed(rows_of(spark, [(1, 1, 1)]))
    assert alone == state_rows(other) < before
    other.stop()
    assert sum(len(r[4]) for r in panes(run)) == 100


def test_slices_of_a_hot_key_make_one_list(spark, tmp_path):
    rows = [(1, i * 0.07 % 20, i) for i in range(300)] + [(1, i * 0.07 % 20, i) for i in range(40)] + [(2, 1, 900)]
    late = [(1, 60 + i, 1000 + i) for i in range(2)]
    got = []
    for slices in (1, 8):
        config = replace(CONFIG, slices=slices, buckets=8)
        run = event_run(spark, tmp_path / str(slices), config)
        for batch in (rows[:200], rows[200:], late):
            run.feed(rows_of(spark, batch))
        run.stop()
        if slices > 1:
            frame = results.of_kind(run.results(), "on_time").filter("k = 1")
            assert frame.count() == 300
        got.append(panes(run, config))
    assert got[0] == got[1] and max(len(r[4]) for r in got[0]) == 300


def test_results_table_twice_and_compacted(spark, tmp_path):
    table = ResultTable(str(tmp_path))
    frames = [spark.createDataFrame([(i, kind) for i in range(3 * b, 3 * b + 3)], "n long, kind string")
              for b, kind in enumerate(["late", "on_time", "late"])]
    assert table.read(spark, frames[0].schema).count() == 0
    for number, frame in enumerate(frames):
        table.write(frame, number)
    table.write(frames[1], 1)
    content = lambda: sorted(map(tuple, table.read(spark, frames[0].schema).collect()))
    before = content()
    assert [r[0] for r in before] == list(range(9)) and [r[2] for r in before] == [0] * 3 + [1] * 3 + [2] * 3
    table.compact(spark, frames[0].schema)
    assert content() == before and len(table.entries(spark)) == 1
    # The last batch may be run again after the compaction; a new one follows.
    table.write(frames[2], 2)
    assert content() == before
    table.write(frames[0], 3)
    assert len(content()) == 12 and len(table.entries(spark)) == 2
    table.compact(spark, frames[0].schema)
    assert len(content()) == 12 and len(table.entries(spark)) == 1


def test_early_and_final_panes_on_the_wall_clock(spark, tmp_path):
    config = replace(CONFIG, custom_window_ms=40_000, early_fire_ms=4_000, lateness_ms=2_000, buckets=1)
    schema = T.StructType.fromDDL(SCHEMA)
    job = lambda r: custom_window_stream(r, LAYOUT, config, TimeDomain.PROCESSING)
    run = Replay(spark, schema, job, str(tmp_path))
    start = int(time.time() * 1000) // 40_000 * 40_000
    if time.time() * 1000 > start + 20_000:
        time.sleep((start + 40_000) / 1000 - time.time())
        start += 40_000
    at = lambda s, n: (1, start + s, n, n)
    run.put(spark.createDataFrame([at(0, 0), at(5, 1), (1, start - 90_000, 2, 2)], SCHEMA).coalesce(1))
    while time.time() * 1000 < start + 45_000:
        time.sleep(0.5)
    run.put(spark.createDataFrame([at(7, 3)], SCHEMA).coalesce(1))
    deadline = time.time() + 40
    while results.of_kind(run.results(), "late").count() < 2 and time.time() < deadline:
        time.sleep(1)
    left = state_rows(run)
    run.stop()
    rows = run.results()
    lists = results.custom_window_panes(rows, LAYOUT, config).filter(F.col("w_start") == start)
    got = sorted((r.pane, r.kind, [c.n for c in r.companies]) for r in lists.collect())
    assert got[-1] == (10, "final", [0, 1]) and len(got) >= 3
    assert all(kind == "early" and ns == [0, 1] and 1 <= pane <= 9 for pane, kind, ns in got[:-1])
    # The old row and the one after the end are late; nothing is left of the window.
    assert sorted(r.n for r in results.of_kind(rows, "late").collect()) == [2, 3]
    assert left == 0


COMPANY = Layout(("id",), "eventTime", ("arr", "offset"),
                 ("id", "companyName", "tradeLicenseNumber", "match", "eventTime", "shareHolders"))


def payload(i, second, licence='"L"'):
    return (f'{{"id": {i}, "companyName": "C", "tradeLicenseNumber": {licence}, "match": false, "eventTime": '
            f'{BASE + second * 1000}, "shareHolders": [{{"id": 1, "cif": "x", "firstName": "Ben", "lastName": "S", '
            '"match": false}]}')


def test_one_parse_serves_results_late_rows_and_dead_letters(spark, tmp_path):
    schema = T.StructType.fromDDL("value string, arr long, topic string, partition int, offset long")
    job = lambda r: event_time_stream(company_columns(parse_company_json(r)), COMPANY, CONFIG)
    run = Replay(spark, schema, job, str(tmp_path / "job"))
    batches = [[payload(1, 1), payload(1, 2, "L\""), payload(2, 3)], [payload(1, 70), "{", payload(2, 75)],
               [payload(2, 4)]]
    offset, read = 0, 0
    for batch in batches:
        rows = [(value, offset + i, "in", 0, offset + i) for i, value in enumerate(batch)]
        offset += len(batch)
        run.feed(spark.createDataFrame(rows, schema).coalesce(1))
    read = sum(p.numInputRows for p in run.query.recentProgress)
    run.stop()
    assert read == offset == 7
    rows = run.results()
    dead = sorted((r.offset, r.reason, bytes(r.value).decode(), r.topic) for r in results.dead_letters(rows).collect())
    assert dead == [(1, "malformed payload", batches[0][1], "in"), (4, "malformed payload", "{", "in")]
    lists = results.event_time_panes(rows, COMPANY, CONFIG)
    assert sorted((r.id, len(r.companies)) for r in lists.collect()) == [(1, 1), (2, 1)]
    assert [r.id for r in results.late_results(rows, COMPANY).collect()] == [2]

    # The same input to the message sink: one message a list, late row and dead letter.
    sent = []
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "job" / "input" / "*"))
    config = replace(CONFIG, late_topic="late", results_topic="lists", dead_letter_topic="dead")
    query = start_messages(
        job(source), lambda b: result_messages(b, COMPANY, config, lambda c: F.to_json(c), lambda c: F.to_json(c)),
        lambda m, n: sent.extend(m.collect()), str(tmp_path / "checkpoint"), once=True)
    query.awaitTermination()
    topics = sorted(m.topic for m in sent)
    # All of it is one micro-batch here, so nothing is late and two windows fire.
    assert topics == ["dead", "dead", "lists", "lists"]
    assert all(m.headers for m in sent if m.topic == "lists")


def test_stamped_rows_keep_the_order_of_their_offsets(spark, tmp_path):
    from paneflow.functions.time import stamp_ingestion

    layout = Layout(("k",), "ms", ("ingest_ms", "partition", "offset"), ("n", "ms"))
    schema = T.StructType.fromDDL("k long, ms long, n long, partition int, offset long")
    config = replace(CONFIG, window_ms=1_000)
    run = Replay(spark, schema, lambda r: ingestion_time_stream(stamp_ingestion(r), layout, config, "ingest_ms"),
                 str(tmp_path))
    rows = [(1, 50 - i, i, i % 2, i) for i in range(20)] + [(1, 50, 0, 0, 20)]
    run.feed(spark.createDataFrame(rows, schema).repartition(3))
    time.sleep(1)
    run.drain(layout, 0, 0)
    run.stop()
    lists = results.ingestion_lists(run.results(), layout, config).collect()
    got = [c.n for r in sorted(lists, key=lambda r: r.w_start) for c in r.companies]
    assert got == [*range(0, 20, 2), 0, *range(1, 20, 2)]


def test_registry_rows_by_their_writer_schema(spark):
    """JSON stands in for Avro, whose package is not here: two writers, one reader."""
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType(), False)])
    first = lambda p: F.from_json(p.cast("string"), "id long, name string")

    def second(value):
        own = F.from_json(value.cast("string"), "key long, label string")
        return F.struct(own["key"].alias("id"), own["label"].alias("name"))

    body = lambda text, number: registry_frame(F.encode(F.lit(text), "UTF-8"), number)
    values = [body('{"id": 1, "name": "a"}', 7), body('{"key": 2, "label": "b"}', 300), body('{"id": 3}', 9),
              body('{"id": 4}', 7), body("{", 7), F.encode(F.lit("plain"), "UTF-8"), F.lit(None).cast("binary")]
    frame = spark.range(1).select(F.posexplode(F.array(*values)).alias("offset", "value"))
    good, dead = split_valid(decode_registry(registry_payload(frame), {7: first, 300: second}, schema))
    assert sorted((r.rec.id, r.rec.name) for r in good.collect()) == [(1, "a"), (2, "b")]
    assert {r.offset: r.reason for r in dead.collect()} == {
        2: "unknown schema id: 9", 3: "missing required field: name", 4: "malformed payload",
        5: "no registry header", 6: "no registry header"}
    with pytest.raises(ValueError):
        decode_registry(registry_payload(frame), {}, schema)


def test_paced_load_drives_the_job(spark, tmp_path):
    """Ten ids taking turns, two seconds of event time a batch, until windows fire."""
    prepare(spark)
    load = synthetic_stream(spark, rows_per_batch=10, batch_ms=8_000, ids=10, start_ms=BASE)
    load = load.withColumns({"arr": F.col("eventTime"), "offset": F.col("id")})
    out = event_time_stream(load, COMPANY, CONFIG)
    table = ResultTable(str(tmp_path / "table"))
    query = start_results(out, table, str(tmp_path / "checkpoint"))
    deadline = time.time() + 120
    while (query.lastProgress is None or query.lastProgress.batchId < 6) and time.time() < deadline:
        time.sleep(0.5)
    query.stop()
    lists = results.event_time_panes(table.read(spark, out.schema), COMPANY, CONFIG)
    got = [(r.id, len(r.companies)) for r in lists.filter(F.col("w_start") == BASE // 20_000 * 20_000).collect()]
    # 8, 16 and 24 s after a multiple of 20 s: two or three batches to a window.
    assert sorted(i for i, _ in got) == list(range(10)) and {n for _, n in got} <= {2, 3}


class _Kept:
    """A state variable in memory that counts accesses."""

    calls = 0

    def __init__(self):
        self.held = {}

    def __getattr__(self, name):
        held = self.held
        done = {
            "exists": lambda: bool(held), "clear": lambda: held.clear(),
            "get": lambda: held.get("it"), "update": lambda v: held.update(it=v),
            "containsKey": lambda k: k in held, "getValue": lambda k: held[k],
            "updateValue": lambda k, v: held.update({k: v}), "removeKey": lambda k: held.pop(k),
            "values": lambda: iter(list(held.values())),
        }[name]

        def call(*args):
            _Kept.calls += 1
            return done(*args)
        return call


class _Handle:
    getMapState = getValueState = lambda self, *_: _Kept()


def test_state_is_kept_many_rows_at_a_time():
    """Long windows cost fewer accesses to state than rows; records, copies and freshness as
    with one entry per record, in one batch or many."""
    bodies = [f'{{"n":{i}}}' for i in range(9_000)]
    frame = pd.DataFrame({"digest": [hashlib.sha256(b.encode()).hexdigest() for b in bodies], "body": bodies})
    for size in (9_000, 700):
        own = LatenessProcessor(None)
        own.init(_Handle())
        _Kept.calls = 0
        for i in range(0, 9_000, size):
            part = frame[i:i + size]
            assert own._store(pd.concat([part, part[:5]])) == [True] * len(part) + [False] * 5
        assert _Kept.calls < 9_000
        assert not any(own._store(frame[5:600:7]))
        shown = [b for f in own._contents(0, "on_time") for b in f["body"]]
        assert shown == bodies
        own._clear()
        assert list(own._contents(0, "on_time")) == []
