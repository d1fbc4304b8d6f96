"""Kafka input. Needs Spark's Kafka package on the session's class path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneflow.config import JobConfig

# Fixed values of the registry wire format: a zero byte, then a 4-byte schema id.
MAGIC = 0
HEADER_BYTES = 5


def _options(config: JobConfig, starting: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": config.brokers,
        "subscribe": config.input_topic,
        "startingOffsets": starting,
    }


def kafka_stream(spark: SparkSession, config: JobConfig, starting: str = "latest") -> DataFrame:
    """Input topic as a stream: value and its topic, partition, offset, timestamp."""
    reader = spark.readStream.format("kafka").options(**_options(config, starting))
    return _columns(reader.load())


def read_kafka(spark: SparkSession, config: JobConfig) -> DataFrame:
    """Everything now in the input topic, as a batch."""
    reader = spark.read.format("kafka").options(**_options(config, "earliest"))
    return _columns(reader.load())


def _columns(rows: DataFrame) -> DataFrame:
    return rows.select("value", "topic", "partition", "offset", "timestamp")


def registry_payload(rows: DataFrame, value: str = "value") -> DataFrame:
    """Take the registry header off a binary value: `schema_id` (null when the
    value has no such header) and `payload`."""
    head = F.hex(F.substring(value, 1, HEADER_BYTES))
    framed = (F.length(value) > HEADER_BYTES) & head.startswith(f"{MAGIC:02X}")
    schema_id = F.conv(F.substring(head, 3, 8), 16, 10).cast("int")
    payload = F.expr(f"substring({value}, {HEADER_BYTES + 1})")
    return rows.withColumns(
        {"schema_id": F.when(framed, schema_id), "payload": F.when(framed, payload)}
    )


def registry_frame(payload: Column, schema_id: int) -> Column:
    """Put the registry header before an Avro-encoded value."""
    header = F.unhex(F.lit(f"{MAGIC:02X}{schema_id:08X}"))
    return F.concat(header, payload)
