"""The engine's operators on the `events` table, one query each.

`events` comes in time order and without copies, so most queries run on a
recorded-stream view of it: arrival is delayed by an amount that depends on the
event, and every tenth event is delivered twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneflow.config import JobConfig
from paneflow.functions.time import (
    TimeDomain,
    event_millis,
    iso_millis,
    iso_text,
    next_instant,
    stamp_ingestion,
    with_windows,
)
from paneflow.layout import Layout
from paneflow.operators.lateness import accepted_rows, late_count, late_rows, with_status
from paneflow.operators.lists import WINDOW, concat_lists, window_lists, wrap
from paneflow.operators.watermark import batch_watermark, row_watermark
from paneflow.plans.batch import custom_window_job, event_time_job, ingestion_time_job
from paneflow.session import shared_folder, utc
from paneflow.sources.payload import company_columns, parse_company_json, parse_json, split_valid
from paneflow.sources.synthetic import per_id_events, rounds
from paneflow.streaming import results as fired
from paneflow.streaming.jobs import (
    custom_window_stream,
    event_time_stream,
    ingestion_time_stream,
)
from paneflow.streaming.replay import Replay, replay
from paneflow.streaming.sinks import LateCounter

HOUR_MS = 3_600_000
DAY_MS = 86_400_000
MINUTE_MS = 60_000
BATCH_MS = 6 * HOUR_MS
# Part size of the query that shows long lists in parts.
SHORT_PART = 40
# Every event of the load queries starts here: 2024-01-01T00:00:00Z.
LOAD_BASE_MS = 1_704_067_200_000

CONFIG = JobConfig(
    window_ms=HOUR_MS,
    lateness_ms=20 * MINUTE_MS,
    watermark_delay_ms=10 * MINUTE_MS,
    custom_window_ms=HOUR_MS,
    early_fire_ms=10 * MINUTE_MS,
)
RECORD = ("event_id", "event_type", "value", "props", "ms")
BY_USER = Layout(("user_id",), "ms", ("arr", "event_id", "dup"), RECORD)
BY_TYPE = Layout(("event_type",), "ms", ("arr", "event_id", "dup"), RECORD)
# In the original table rows arrive when they happen.
IN_ORDER = Layout(("user_id",), "ms", ("ms", "event_id"), RECORD)

PAYLOAD = T.StructType([T.StructField("k", T.LongType(), False)])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    utc(spark)
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    return table.select(
        "event_id", "user_id", "event_type", "value", "props", event_millis("ts").alias("ms")
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded-stream view: `arr` is the arrival clock, `dup` marks a second delivery."""
    delay = (F.col("event_id") * 7919) % 97 * MINUTE_MS
    copies = F.when(
        F.col("event_id") % 10 == 3, F.array(F.lit(0), F.lit(1))
    ).otherwise(F.array(F.lit(0)))
    rows = events(spark, sf_dir).withColumn("dup", F.explode(copies))
    return rows.withColumn("arr", F.col("ms") + delay + F.col("dup") * 5 * MINUTE_MS)


def _seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = with_windows(arrivals(spark, sf_dir), "ms", CONFIG.window_ms)
    return with_status(
        row_watermark(placed, BY_USER, CONFIG.watermark_delay_ms), CONFIG.lateness_ms
    )


def _ids(records: Column) -> Column:
    return F.array_join(F.transform(records, lambda r: r["event_id"].cast("string")), ",")


def _listing(lists: DataFrame, *columns: str, records: Column | None = None) -> DataFrame:
    """Lists as text of event ids and a count, which compare well."""
    recs = F.transform("items", lambda x: x["rec"]) if records is None else records
    return lists.select(
        *columns, F.size(recs).cast("long").alias("n"), _ids(recs).alias("ids")
    )


def _panes(panes: DataFrame, key: str = "user_id") -> DataFrame:
    columns = (key, "w_start", "w_end", "part", "pane", "kind")
    return _listing(panes, *columns, records=F.col("companies")).withColumn(
        "pane", F.col("pane").cast("long")
    )


def event_window_distinct_sorted(spark, sf_dir):
    placed = with_windows(arrivals(spark, sf_dir), "ms", CONFIG.window_ms)
    return _listing(window_lists(placed, BY_USER), "user_id", "w_start", "w_end", "part")


def ingest_window_concat(spark, sf_dir):
    placed = with_windows(arrivals(spark, sf_dir), "arr", CONFIG.window_ms)
    return _listing(concat_lists(placed, BY_USER), "user_id", "w_start", "w_end", "part")


def ingestion_time_results(spark, sf_dir):
    out = ingestion_time_job(arrivals(spark, sf_dir), BY_TYPE, CONFIG)
    columns = ("event_type", "w_start", "w_end", "part")
    return _listing(out, *columns, records=F.col("companies"))


def aligned_window_30s(spark, sf_dir):
    placed = with_windows(arrivals(spark, sf_dir), "ms", 30_000)
    return _listing(window_lists(placed, BY_TYPE), "event_type", "w_start", "w_end", "part")


def window_lists_in_parts(spark, sf_dir):
    placed = with_windows(arrivals(spark, sf_dir), "ms", DAY_MS)
    lists = window_lists(placed, BY_TYPE, part_rows=SHORT_PART)
    return _listing(lists, "event_type", "w_start", "w_end", "part")


def concat_lists_in_parts(spark, sf_dir):
    placed = with_windows(arrivals(spark, sf_dir), "arr", DAY_MS)
    lists = concat_lists(placed, BY_TYPE, part_rows=SHORT_PART)
    return _listing(lists, "event_type", "w_start", "w_end", "part")


def watermark_trace(spark, sf_dir):
    rows = row_watermark(arrivals(spark, sf_dir), BY_USER, CONFIG.watermark_delay_ms)
    return rows.select("arr", "event_id", "dup", "ms", "wm")


def micro_batch_watermark(spark, sf_dir):
    rows = arrivals(spark, sf_dir).withColumn("batch", F.floor(F.col("arr") / BATCH_MS))
    rows = batch_watermark(rows, BY_USER, CONFIG.watermark_delay_ms, "batch")
    return rows.select("batch", "event_id", "dup", "wm")


def row_lateness_status(spark, sf_dir):
    names = F.element_at(F.array(*map(F.lit, ("on_time", "allowed", "late"))), F.col("status") + 1)
    return _seen(spark, sf_dir).select("event_id", "dup", "w_end", "wm", names.alias("status"))


def window_results_final(spark, sf_dir):
    lists = window_lists(accepted_rows(_seen(spark, sf_dir)), BY_USER)
    return _listing(lists, "user_id", "w_start", "w_end", "part")


def late_side_output(spark, sf_dir):
    return late_rows(_seen(spark, sf_dir)).select(
        "user_id", "w_start", "w_end", "event_id", "dup", "event_type", "value", "props", "ms"
    )


def late_counter(spark, sf_dir):
    rows = _seen(spark, sf_dir).withColumn("day", F.floor(F.col("arr") / DAY_MS))
    return late_count(rows, "day")


def _event_time(spark, sf_dir, kinds: tuple[str, ...], layout: Layout = BY_USER,
                config: JobConfig = CONFIG):
    out = event_time_job(arrivals(spark, sf_dir), layout, config)
    return _panes(out.results.filter(F.col("kind").isin(*kinds)), layout.keys[0])


def on_time_results(spark, sf_dir):
    return _event_time(spark, sf_dir, ("on_time",))


def allowed_late_refires(spark, sf_dir):
    return _event_time(spark, sf_dir, ("refire",))


SMALL_PARTS = replace(CONFIG, part_rows=2)


def refires_full_small_parts(spark, sf_dir):
    """Every window of more than two rows comes in parts, by position in its pane."""
    return _event_time(spark, sf_dir, ("on_time", "refire"), BY_TYPE, SMALL_PARTS)


def refires_delta(spark, sf_dir):
    return _event_time(
        spark, sf_dir, ("refire_delta",), BY_TYPE, replace(SMALL_PARTS, refire="delta")
    )


def event_time_results(spark, sf_dir):
    return _panes(event_time_job(arrivals(spark, sf_dir), BY_USER, CONFIG).all())


def _custom(spark, sf_dir, domain: TimeDomain):
    return custom_window_job(arrivals(spark, sf_dir), BY_USER, CONFIG, domain)


def early_fire_panes(spark, sf_dir):
    out = _custom(spark, sf_dir, TimeDomain.PROCESSING).results
    return _panes(out.filter(F.col("kind") == "early"))


def early_fire_panes_event_time(spark, sf_dir):
    out = _custom(spark, sf_dir, TimeDomain.EVENT).results
    return _panes(out.filter(F.col("kind") == "early"))


def final_fire_at_lateness(spark, sf_dir):
    out = _custom(spark, sf_dir, TimeDomain.PROCESSING).results
    return _panes(out.filter(F.col("kind") == "final"))


def custom_window_results(spark, sf_dir):
    return _panes(_custom(spark, sf_dir, TimeDomain.PROCESSING).all())


def custom_window_results_event_time(spark, sf_dir):
    return _panes(_custom(spark, sf_dir, TimeDomain.EVENT).all())


def _payloads(spark, sf_dir) -> DataFrame:
    """Payload text as it might come in: cut short, or without a value."""
    damaged = (
        F.when(F.col("event_id") % 17 == 0, F.expr("left(props, length(props) - 1)"))
        .when(F.col("event_id") % 19 == 0, F.lit('{"k": null}'))
        .when(F.col("event_id") % 23 == 0, F.lit("{}"))
        .otherwise(F.col("props"))
    )
    return events(spark, sf_dir).select(
        "event_id", damaged.alias("value"), F.col("event_id").alias("offset")
    )


def dead_letter_split(spark, sf_dir):
    _, dead = split_valid(parse_json(_payloads(spark, sf_dir), PAYLOAD))
    return dead.select(
        F.col("offset").alias("event_id"), "reason", F.col("value").cast("string").alias("value")
    )


def valid_split(spark, sf_dir):
    good, _ = split_valid(parse_json(_payloads(spark, sf_dir), PAYLOAD))
    return good.select("event_id", F.col("rec.k").alias("k"))


def _company_json() -> Column:
    """A hand-written style payload: ISO event time with an offset for even event
    ids, share holders without account and full name, an unquoted licence now and then."""
    ahead = F.date_format(
        F.timestamp_millis(F.col("ms") + 4 * HOUR_MS), "yyyy-MM-dd'T'HH:mm:ss.SSS"
    )
    when = F.when(
        F.col("event_id") % 2 == 0, F.concat(F.lit('"'), ahead, F.lit('+04:00"'))
    ).otherwise(F.col("ms").cast("string"))
    quote = F.when(F.col("event_id") % 13 == 0, F.lit("")).otherwise(F.lit('"'))
    cif = F.when(F.col("event_id") % 29 == 0, F.lit("null")).otherwise(F.lit('"cif"'))
    return F.concat(
        F.lit('{"id": '), F.col("user_id").cast("string"),
        F.lit(', "companyName": "skyknight", "tradeLicenseNumber": '), quote,
        F.col("event_type"), F.lit('", "match": false, "eventTime": '), when,
        F.lit(', "shareHolders": [{"id": '), F.col("event_id").cast("string"),
        F.lit(', "cif": '), cif,
        F.lit(', "firstName": "Ben", "lastName": "Stone", "match": false}]}'),
    )


def _companies(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    sent = arrivals(spark, sf_dir).select(
        "event_id", "dup", "arr", _company_json().alias("value"), F.col("event_id").alias("offset")
    )
    return split_valid(parse_company_json(sent))


def company_payloads(spark, sf_dir):
    good, _ = _companies(spark, sf_dir)
    holder = F.col("rec.shareHolders")[0]
    return good.select(
        "event_id",
        "dup",
        F.col("rec.id").alias("id"),
        F.col("rec.companyName").alias("company_name"),
        F.col("rec.tradeLicenseNumber").alias("trade_license_number"),
        F.col("rec.match").alias("match"),
        F.col("rec.eventTime").alias("event_time"),
        F.size("rec.shareHolders").cast("long").alias("n_share_holders"),
        holder["id"].alias("holder_id"),
        F.concat_ws("|", *[holder[f] for f in
                           ("cif", "account", "firstName", "lastName", "fullName")]).alias("holder"),
    )


def company_dead_letters(spark, sf_dir):
    _, dead = _companies(spark, sf_dir)
    return dead.select(
        F.col("offset").alias("event_id"), "reason",
        F.length("value").cast("long").alias("payload_bytes"),
    )


COMPANY = Layout(
    ("id",), "eventTime", ("arr", "event_id", "dup"),
    ("id", "companyName", "tradeLicenseNumber", "match", "eventTime", "shareHolders"),
)


def company_aggregates(spark, sf_dir):
    """Nested payloads to `(id, companies)`, shown as the share-holder ids."""
    good, _ = _companies(spark, sf_dir)
    placed = with_windows(company_columns(good), "eventTime", CONFIG.window_ms)
    lists = window_lists(placed, COMPANY)
    holders = F.transform(
        "items", lambda x: F.concat_ws("@", x["rec"]["shareHolders"][0]["id"].cast("string"),
                                       x["rec"]["eventTime"].cast("string"))
    )
    return lists.select(
        "id", "w_start", "part", F.size("items").cast("long").alias("n"),
        F.array_join(holders, ",").alias("companies"),
    )


def wrap_single(spark, sf_dir):
    one = wrap(events(spark, sf_dir), IN_ORDER)
    return _listing(one, "user_id", records=F.col("companies"))


def iso_event_time(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("iso", iso_text("ms"))
    return rows.select("event_id", "iso", iso_millis("iso").alias("back_ms"))


def next_early_instant(spark, sf_dir):
    rows = arrivals(spark, sf_dir)
    return rows.select(
        "event_id", "dup", next_instant("arr", CONFIG.early_fire_ms).alias("next_ms")
    )


def _load(rows: DataFrame) -> DataFrame:
    holders = F.transform("shareHolders", lambda h: F.concat_ws("/", h["cif"], h["fullName"]))
    return rows.select(
        "id", "companyName", "tradeLicenseNumber", "match", "eventTime",
        F.array_join(holders, ";").alias("share_holders"),
    )


def synthetic_events(spark, sf_dir):
    utc(spark)
    ids = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    return _load(per_id_events(ids, "c_custkey", base_ms=LOAD_BASE_MS))


def synthetic_rounds(spark, sf_dir):
    numbers = events(spark, sf_dir).select("event_id")
    return _load(rounds(numbers, "event_id", base_ms=LOAD_BASE_MS))


# Micro-batches in which the recorded stream is fed to a streaming job.
MICRO_BATCHES = 5
STREAMED = replace(CONFIG, buckets=4, lateness_ms=6 * HOUR_MS)


def held_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recorded stream with some rows held back for hours, so that micro-batches meet
    allowed-late and late rows at every scale."""
    hours = F.col("event_id") % 7 * 2
    return arrivals(spark, sf_dir).withColumn("arr", F.col("arr") + hours * HOUR_MS)


def _micro_batches(rows: DataFrame) -> DataFrame:
    """Number the rows' micro-batches: equal stretches of the arrival clock."""
    low, high = rows.agg(F.min("arr"), F.max("arr")).first()
    width = (high or 0) - (low or 0) + 1
    return rows.withColumn("batch", F.floor((F.col("arr") - F.lit(low)) * MICRO_BATCHES / F.lit(width)))


def _replayed(spark, rows: DataFrame, job, name: str) -> Replay:
    return replay(_micro_batches(rows), "batch", job, shared_folder(spark, name))


# The event-time job's run over a table, by session and table: several queries show it.
_EVENT_TIME_RUNS: dict[tuple[str, str], tuple[Replay, int]] = {}


def _event_time_run(spark, sf_dir) -> tuple[Replay, int]:
    """The event-time job over disordered rows, and its late-row metric."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _EVENT_TIME_RUNS:
        counter = LateCounter()
        spark.streams.addListener(counter)
        try:
            job = lambda rows: event_time_stream(rows, BY_USER, STREAMED)
            run = _replayed(spark, held_back(spark, sf_dir), job, "stream_event_time")
            counter.wait(str(run.query.runId))
        finally:
            spark.streams.removeListener(counter)
        _EVENT_TIME_RUNS[key] = run, counter.of(str(run.query.id))
    return _EVENT_TIME_RUNS[key]


def _to_end(spark, sf_dir, job, name: str) -> DataFrame:
    """What a job fires over the table in its own order, all windows closed at the end."""
    rows = events(spark, sf_dir)
    most = rows.agg(F.max("ms")).first()[0] or 0
    run = Replay(spark, rows.schema, job, shared_folder(spark, name))
    try:
        run.feed(rows)
        run.drain(IN_ORDER, most, STREAMED.watermark_delay_ms + 2 * HOUR_MS + STREAMED.lateness_ms)
    finally:
        run.stop()
    return run.results()


def stream_event_time_results(spark, sf_dir):
    """The event-time job as a streaming query over the table, one run to its end."""
    job = lambda rows: event_time_stream(rows, IN_ORDER, STREAMED)
    panes = fired.event_time_panes(_to_end(spark, sf_dir, job, "events"), IN_ORDER, STREAMED)
    return _listing(panes, "user_id", "w_start", "w_end", "kind", records=F.col("companies"))


def stream_ingestion_results(spark, sf_dir):
    """Incremental list windows as a streaming query over the table."""
    job = lambda rows: ingestion_time_stream(rows, IN_ORDER, STREAMED, "ms")
    lists = fired.ingestion_lists(_to_end(spark, sf_dir, job, "ingested"), IN_ORDER, STREAMED)
    return _listing(lists, "user_id", "w_start", "w_end", "kind", records=F.col("companies"))


def stream_fired_panes(spark, sf_dir):
    """Everything the event-time job fired over disordered rows, micro-batch by micro-batch;
    windows that the watermark has not closed stay open."""
    rows = _event_time_run(spark, sf_dir)[0].results()
    panes = fired.event_time_panes(rows, BY_USER, STREAMED)
    return _panes(panes.unionByName(fired.late_results(rows, BY_USER)))


def stream_refires(spark, sf_dir):
    """What each allowed-late row added, as fired."""
    rows = fired.of_kind(_event_time_run(spark, sf_dir)[0].results(), "refire")
    return rows.select("user_id", "w_start", "w_end", "event_id", "dup", "fresh")


def stream_late_rows(spark, sf_dir):
    rows = fired.of_kind(_event_time_run(spark, sf_dir)[0].results(), "late")
    return rows.select("user_id", "w_start", "w_end", "event_id", "dup", "event_type", "value",
                       "props", "ms")


def stream_late_counter(spark, sf_dir):
    """The late-row metric of the running job, as its listener counted it."""
    return spark.createDataFrame([(_event_time_run(spark, sf_dir)[1],)], "late long")


def stream_custom_window_results(spark, sf_dir):
    """Early panes, final panes and late rows of the custom-window job on the watermark."""
    job = lambda rows: custom_window_stream(rows, BY_USER, STREAMED, TimeDomain.EVENT)
    rows = _replayed(spark, held_back(spark, sf_dir), job, "stream_custom").results()
    panes = fired.custom_window_panes(rows, BY_USER, STREAMED)
    return _panes(panes.unionByName(fired.late_results(rows, BY_USER)))


def stream_ingestion_lists(spark, sf_dir):
    """The ingestion-time job over several micro-batches, the arrival clock being the time
    of ingestion."""
    job = lambda rows: ingestion_time_stream(rows, BY_USER, STREAMED, "arr")
    rows = _replayed(spark, held_back(spark, sf_dir), job, "stream_ingestion").results()
    return _panes(fired.ingestion_lists(rows, BY_USER, STREAMED))


STAMPED = Layout(
    ("user_id",), "ms", ("ingest_ms", "partition", "offset"), (*RECORD, "dup")
)


def stream_ingestion_stamps(spark, sf_dir):
    """Each key's rows in order of ingestion: stamped as their micro-batch is read, rows of
    one stamp by partition and offset."""
    config = replace(STREAMED, window_ms=1_000)
    job = lambda rows: ingestion_time_stream(
        stamp_ingestion(rows), STAMPED, config, "ingest_ms"
    )
    rows = held_back(spark, sf_dir).select(
        "user_id", *STAMPED.record, "arr", (F.col("user_id") % 3).cast("int").alias("partition"),
        (F.col("event_id") * 2 + F.col("dup")).alias("offset"),
    )
    numbered = _micro_batches(rows)
    run = replay(numbered, "batch", job, shared_folder(spark, "stream_stamped"))
    # A row read later, once the last windows are over, lets them fire.
    time.sleep(config.window_ms / 1000)
    try:
        run.drain(STAMPED, 0, 0)
    finally:
        run.stop()
    lists = fired.ingestion_lists(run.results(), STAMPED, config)
    taken = lists.select("user_id", "w_start", "part", F.posexplode("companies").alias("pos", "rec"))
    order = W.partitionBy("user_id").orderBy("w_start", "part", "pos")
    return taken.select(
        "user_id", "rec.event_id", "rec.dup", F.row_number().over(order).cast("long").alias("nth")
    )


def job_with_dead_letters(spark, sf_dir):
    """The event-time job from payload to results: one parse, its good rows gathered, late
    rows and dead letters beside them."""

    def job(sent: DataFrame) -> DataFrame:
        parsed = parse_company_json(sent)
        return event_time_stream(company_columns(parsed), COMPANY, STREAMED)

    sent = held_back(spark, sf_dir).select(
        "event_id", "dup", "arr", _company_json().alias("value"),
        (F.col("event_id") * 2 + F.col("dup")).alias("offset"),
    )
    rows = _replayed(spark, sent, job, "stream_companies").results()
    panes = fired.event_time_panes(rows, COMPANY, STREAMED)
    panes = panes.unionByName(fired.late_results(rows, COMPANY))
    holders = F.transform(
        "companies", lambda c: F.concat_ws("@", c["shareHolders"][0]["id"].cast("string"),
                                           c["eventTime"].cast("string"))
    )
    none = F.lit(None)
    lists = panes.select(
        "kind", "id", "w_start", F.col("pane").cast("long").alias("pane"),
        F.array_join(holders, ",").alias("companies"), none.cast("string").alias("reason"),
        none.cast("long").alias("offset"),
    )
    dead = fired.dead_letters(rows).select(
        F.lit("dead_letter").alias("kind"), none.cast("long").alias("id"),
        none.cast("long").alias("w_start"), none.cast("long").alias("pane"),
        none.cast("string").alias("companies"), "reason", "offset",
    )
    return lists.unionByName(dead)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        event_window_distinct_sorted,
        ingest_window_concat,
        ingestion_time_results,
        aligned_window_30s,
        window_lists_in_parts,
        concat_lists_in_parts,
        watermark_trace,
        micro_batch_watermark,
        row_lateness_status,
        window_results_final,
        late_side_output,
        late_counter,
        on_time_results,
        allowed_late_refires,
        refires_full_small_parts,
        refires_delta,
        event_time_results,
        early_fire_panes,
        early_fire_panes_event_time,
        final_fire_at_lateness,
        custom_window_results,
        custom_window_results_event_time,
        dead_letter_split,
        valid_split,
        company_payloads,
        company_dead_letters,
        company_aggregates,
        wrap_single,
        iso_event_time,
        next_early_instant,
        synthetic_events,
        synthetic_rounds,
        stream_event_time_results,
        stream_ingestion_results,
        stream_fired_panes,
        stream_refires,
        stream_late_rows,
        stream_late_counter,
        stream_custom_window_results,
        stream_ingestion_lists,
        stream_ingestion_stamps,
        job_with_dead_letters,
    )
}
