"""The three jobs as Structured Streaming queries.

A job takes rows with the columns of a layout and gives fired rows: those columns, `w_start`,
`w_end`, `kind`, `fired_at` (the instant of an early or final pane) and `fresh` (false for an
allowed-late row that the window had already). Rows that parsing marked with a `reason` go
through the same operator untouched as kind `dead_letter`, so that one parse and one scan
serve results, late rows and dead letters alike. `streaming.results` makes lists of them.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneflow.config import JobConfig
from paneflow.functions.time import TimeDomain, event_timestamp, with_windows
from paneflow.layout import Layout
from paneflow.session import ROCKSDB_PROVIDER
from paneflow.sources.payload import ORIGIN
from paneflow.streaming import processors
from paneflow.streaming.processors import (
    HORIZON_MS,
    NO_WINDOW,
    EarlyFireProcessor,
    LatenessProcessor,
    WindowProcessor,
    WindowSettings,
)

# Processors travel to the executors as code, so the package need not be there.
cloudpickle.register_pickle_by_value(processors)

# Records differing in a microsecond are different records.
EXACT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# Fields of `dead_letter`, which rows of jobs over parsed payloads have.
DEAD_LETTER = {"reason": "string", "value": "binary", **ORIGIN}


def prepare(spark: SparkSession) -> SparkSession:
    """State in RocksDB, on disk and with its changes logged per batch."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )
    return spark


def _text(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false", **EXACT_TIMES})


def _body(rows: DataFrame, layout: Layout) -> tuple[list[Column], T.StructType]:
    """Columns that travel through the operator as one JSON text, so that Python stores
    and passes them without taking them apart."""
    names = list(dict.fromkeys([*layout.keys, layout.event_ms, *layout.arrival, *layout.record]))
    columns = [F.col(n) for n in names]
    fields = [T.StructField(n, rows.schema[n].dataType) for n in names]
    if "reason" in rows.columns:
        parts = [
            (F.col(name) if name in rows.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in DEAD_LETTER.items()
        ]
        columns.append(F.when(F.col("reason").isNotNull(), F.struct(*parts)).alias("dead_letter"))
        fields.append(T.StructField("dead_letter", T.StructType(
            [T.StructField(n, T._parse_datatype_string(k)) for n, k in DEAD_LETTER.items()])))
    return columns, T.StructType(fields)


def _stateful(
    rows: DataFrame,
    layout: Layout,
    config: JobConfig,
    size_ms: int,
    processor: WindowProcessor,
    event_domain: bool,
    distinct: bool = True,
    time: str | None = None,
) -> DataFrame:
    """Run a processor per bucket of keys and window of `time`, the event time if not given.

    A bucket is a hash of the key and of a stretch of the window's time span. With
    `config.slices` above 1 a busy key's rows are spread over that many buckets; copies of a
    record have one event time and so stay together. What the buckets of a window fire at
    one instant fires in one micro-batch, so lists come out whole.
    """
    time = time or layout.event_ms
    placed = with_windows(rows, time, size_ms)
    cut = F.floor((F.col(time) - F.col("w_start")) * config.slices / size_ms)
    bucket = F.pmod(F.xxhash64(*layout.keys, cut), F.lit(config.buckets))
    columns, shape = _body(rows, layout)
    same = [F.col(c) for c in (*layout.keys, *(layout.record if distinct else layout.arrival))]
    dead = F.col("reason").isNotNull() if "reason" in rows.columns else F.lit(False)
    slim = placed.select(
        # Dead letters spread over all buckets; they meet no state.
        F.when(dead, F.pmod(F.xxhash64(*layout.arrival), F.lit(config.buckets))).otherwise(bucket).alias("bucket"),
        F.when(dead, F.lit(NO_WINDOW)).otherwise(F.col("w_start")).alias("w_start"),
        *[F.col(c).alias(f"arrival_{i}") for i, c in enumerate(layout.arrival)],
        F.sha2(_text(F.struct(*same)), 256).alias("digest"),
        _text(F.struct(*columns)).alias("body"),
        F.when(~dead, event_timestamp(time)).alias("event_ts"),
    )
    if event_domain:
        slim = slim.withWatermark("event_ts", f"{HORIZON_MS} milliseconds")
    mode = TimeDomain.EVENT if event_domain else TimeDomain.PROCESSING
    out = slim.groupBy("bucket", "w_start").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType="w_start long, kind string, fired_at long, fresh boolean, body string",
        outputMode="append",
        timeMode=mode.value,
    )
    start = F.when(F.col("kind") != "dead_letter", F.col("w_start"))
    return out.select(
        start.alias("w_start"),
        (start + F.lit(size_ms)).alias("w_end"),
        "kind",
        "fired_at",
        "fresh",
        F.from_json("body", shape, EXACT_TIMES).alias("body"),
    ).select("w_start", "w_end", "kind", "fired_at", "fresh", "body.*")


def _settings(layout: Layout, config: JobConfig, size_ms: int, event: bool, delay_ms: int) -> WindowSettings:
    return WindowSettings(
        size_ms=size_ms,
        lateness_ms=config.lateness_ms,
        shift_ms=HORIZON_MS - delay_ms if event else 0,
        arrival=tuple(f"arrival_{i}" for i in range(len(layout.arrival))),
        early_ms=config.early_fire_ms,
        event_domain=event,
    )


def event_time_stream(rows: DataFrame, layout: Layout, config: JobConfig) -> DataFrame:
    """Event-time windows with allowed lateness; kinds `on_time`, `refire`, `late`."""
    settings = _settings(layout, config, config.window_ms, True, config.watermark_delay_ms)
    return _stateful(rows, layout, config, config.window_ms, LatenessProcessor(settings), True)


def custom_window_stream(
    rows: DataFrame,
    layout: Layout,
    config: JobConfig,
    domain: TimeDomain = TimeDomain.PROCESSING,
) -> DataFrame:
    """Event-time windows fired on the wall clock or on the watermark; kinds `early`,
    `final` and `late`."""
    event = domain is TimeDomain.EVENT
    settings = _settings(layout, config, config.custom_window_ms, event, config.watermark_delay_ms)
    return _stateful(
        rows, layout, config, config.custom_window_ms, EarlyFireProcessor(settings), event
    )


def ingestion_time_stream(
    rows: DataFrame, layout: Layout, config: JobConfig, ingest_ms: str, delay_ms: int = 0
) -> DataFrame:
    """Windows of ingestion time `ingest_ms`, epoch milliseconds such as `stamp_ingestion`
    adds; every row is kept, copies too. Kind `on_time`; `late` only for times given by
    producers that fall behind the watermark, which then needs a delay.
    """
    settings = _settings(layout, config, config.window_ms, True, delay_ms)
    settings = WindowSettings(**{**settings.__dict__, "lateness_ms": 0})
    return _stateful(
        rows, layout, config, config.window_ms, LatenessProcessor(settings), True,
        distinct=False, time=ingest_ms,
    )


def _built_in(
    rows: DataFrame, layout: Layout, ts: str, delay_ms: int, size_ms: int, slices: int
) -> DataFrame:
    """Windowed gathering with Spark's own streaming aggregation."""
    marked = rows.withWatermark(ts, f"{delay_ms} milliseconds")
    window = F.window(ts, f"{size_ms} milliseconds")
    offset = F.pmod(F.unix_millis(ts), F.lit(size_ms).cast("long"))
    item = F.struct(
        F.col(layout.event_ms).alias("ms"),
        layout.arrival_struct().alias("at"),
        layout.record_struct().alias("rec"),
    )
    return (
        marked.groupBy(
            *layout.keys, window.alias("_w"), F.floor(offset * slices / size_ms).alias("slice")
        )
        .agg(F.collect_list(item).alias("items"))
        .select(
            *layout.keys,
            F.unix_millis("_w.start").alias("w_start"),
            F.unix_millis("_w.end").alias("w_end"),
            "slice",
            F.lit(0).cast("long").alias("part"),
            F.lit(0).alias("pane"),
            F.lit("final").alias("kind"),
            "items",
        )
    )


def fast_ingestion_time_stream(
    rows: DataFrame, layout: Layout, config: JobConfig, ts: str, delay_ms: int = 0
) -> DataFrame:
    """Windows of ingestion time `ts`, a timestamp column, without Python state: one list
    per window (and slice), records in arrival order, copies kept. Rows behind the watermark
    are dropped, so a time given by producers needs a delay."""
    lists = _built_in(rows, layout, ts, delay_ms, config.window_ms, config.slices)
    in_order = F.array_sort(F.transform("items", lambda x: F.struct(x["at"], x["rec"])))
    return lists.withColumn("companies", F.transform(in_order, lambda x: x["rec"])).drop("items")


def fast_event_time_stream(rows: DataFrame, layout: Layout, config: JobConfig) -> DataFrame:
    """Event-time windows without Python state, for when late rows need not be
    kept: one final list per window (and slice), `window delay + lateness` behind."""
    stamped = rows.withColumn("event_ts", event_timestamp(layout.event_ms))
    delay = config.watermark_delay_ms + config.lateness_ms
    lists = _built_in(stamped, layout, "event_ts", delay, config.window_ms, config.slices)
    # Copies sit beside each other once sorted by time and record.
    grouped = F.array_sort(
        F.transform("items", lambda x: F.struct(x["ms"], x["rec"], x["at"]))
    )
    kept = F.filter(
        grouped,
        lambda x, i: (i == 0) | ~x["rec"].eqNullSafe(F.get(grouped, i - 1)["rec"]),
    )
    ordered = F.array_sort(F.transform(kept, lambda x: F.struct(x["ms"], x["at"], x["rec"])))
    return lists.withColumn("companies", F.transform(ordered, lambda x: x["rec"])).drop("items")
