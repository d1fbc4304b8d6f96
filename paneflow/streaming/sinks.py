"""Where results, late rows and dead letters go.

One output carries all kinds of rows, told apart by `kind`, so a batch is computed
and written once: the results table files it by kind, the Kafka sink by topic.
"""

from __future__ import annotations

from dataclasses import replace
from threading import Event

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from paneflow.config import JobConfig
from paneflow.layout import Layout
from paneflow.streaming import results
from paneflow.streaming.table import ResultTable

LATE_METRIC = "late_rows"
MESSAGE_HEADERS = ("w_start", "w_end", "part", "pane", "kind")


def start_results(
    out: DataFrame, table: ResultTable, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Write fired rows to a results table, every kind in one pass."""
    writer = out.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(table.write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def start_console(out: DataFrame, checkpoint: str, rows: int = 20) -> StreamingQuery:
    """Print results, for looking on."""
    return (
        out.writeStream.outputMode("append")
        .format("console")
        .option("truncate", "false")
        .option("numRows", rows)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def kafka_messages(out: DataFrame, config: JobConfig, encode_result, encode_late) -> DataFrame:
    """Result rows as `(topic, key, value)`: lists to the results topic, late rows
    in their original form to the late topic. The encoders turn a column into the
    message value, `to_json` or registry-framed `to_avro`. Headers tell a part, a pane
    and its kind and window apart, so a consumer never takes a part for the whole."""
    late = F.col("kind") == "late"
    id_column = out.columns[0]
    aggregate = F.struct(F.col(id_column).alias("id"), F.col("companies"))
    return out.select(
        F.when(late, F.lit(config.late_topic)).otherwise(F.lit(config.results_topic)).alias("topic"),
        F.col(id_column).cast("string").alias("key"),
        F.when(late, encode_late(F.element_at("companies", 1)).cast("binary"))
        .otherwise(encode_result(aggregate).cast("binary"))
        .alias("value"),
        F.array(
            *[
                F.struct(F.lit(c).alias("key"), F.col(c).cast("string").cast("binary").alias("value"))
                for c in MESSAGE_HEADERS
                if c in out.columns
            ]
        ).alias("headers"),
    )


def avro_encoder(schema_id: int, schema: str | None = None):
    """Encoder to registry-framed Avro. Needs Spark's Avro package."""
    from pyspark.sql.avro.functions import to_avro

    from paneflow.sources.kafka import registry_frame

    def encode(value: Column) -> Column:
        binary = to_avro(value) if schema is None else to_avro(value, schema)
        return registry_frame(binary, schema_id)

    return encode


def dead_letter_messages(dead: DataFrame, config: JobConfig) -> DataFrame:
    """Dead letters as JSON with the reason, the raw payload in base64 and where
    it came from."""
    body = F.to_json(F.struct("reason", "value", "topic", "partition", "offset"))
    return dead.select(F.lit(config.dead_letter_topic).alias("topic"), body.alias("value"))


def result_messages(
    fired: DataFrame, layout: Layout, config: JobConfig, encode_result, encode_late
) -> DataFrame:
    """Messages of the rows that one micro-batch of an event-time job fired: on-time lists,
    what each allowed-late row adds, late rows, and dead letters if the job has them."""
    lists = results.event_time_panes(fired, layout, replace(config, refire="delta"))
    lists = lists.unionByName(results.late_results(fired, layout))
    messages = kafka_messages(lists, config, encode_result, encode_late)
    if "dead_letter" in fired.columns:
        dead = dead_letter_messages(results.dead_letters(fired), config)
        messages = messages.unionByName(dead, allowMissingColumns=True)
    return messages


def start_messages(out: DataFrame, messages, send, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Turn every micro-batch into messages and hand them to `send`, at least once. The batch
    is kept while its kinds are put together, so the job's state runs once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            send(messages(batch), batch_id)
        finally:
            batch.unpersist()

    writer = out.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def kafka_sender(config: JobConfig):
    """Send messages to the topic each row names. Needs Spark's Kafka package."""

    def send(messages: DataFrame, batch_id: int) -> None:
        (
            messages.write.format("kafka")
            .option("kafka.bootstrap.servers", config.brokers)
            .option("includeHeaders", "true")
            .save()
        )

    return send


def count_late(out: DataFrame) -> DataFrame:
    """Have Spark count late rows of every batch under `LATE_METRIC`."""
    return out.observe(LATE_METRIC, F.count(F.when(F.col("kind") == "late", 1)).alias("n"))


class LateCounter(StreamingQueryListener):
    """Number of late rows of a session's queries, from the metric of every batch.

    A query keeps its id over restarts, and a batch that is run again replaces its own
    number, so the total counts each batch once however often the query is stopped.
    """

    def __init__(self) -> None:
        self._batches: dict[tuple[str, int], int] = {}
        self._ended: dict[str, Event] = {}

    @property
    def total(self) -> int:
        return sum(self._batches.values())

    def of(self, query_id: str) -> int:
        return sum(n for (own, _), n in self._batches.items() if own == query_id)

    def wait(self, run_id: str, seconds: float = 30.0) -> bool:
        """Wait until the events of a run that has ended are all in."""
        return self._ended.setdefault(run_id, Event()).wait(seconds)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(LATE_METRIC)
        if seen is not None:
            self._batches[str(progress.id), progress.batchId] = seen.n

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), Event()).set()
