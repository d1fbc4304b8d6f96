"""Time columns: event time, ingestion stamp, windows, ISO text."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"


class TimeDomain(Enum):
    """Clock that drives early and final firing."""

    PROCESSING = "ProcessingTime"
    EVENT = "EventTime"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_millis(ts: Column | str) -> Column:
    """Epoch milliseconds of a timestamp column, zone-less ones taken as UTC
    (the session zone, which `session.utc` pins)."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def event_timestamp(ms: Column | str) -> Column:
    """Timestamp for a watermark, from epoch milliseconds."""
    return F.timestamp_millis(_col(ms))


def stamp_ingestion(rows: DataFrame, name: str = "ingest_ms") -> DataFrame:
    """Stamp rows with the time they were read, epoch milliseconds: one time per micro-batch.
    Rows of equal stamps have a total order only together with where they came from, so an
    arrival order is (stamp, partition, offset)."""
    return rows.withColumn(name, F.unix_millis(F.current_timestamp()))


def window_start(ms: Column | str, size_ms: int) -> Column:
    """Start of the epoch-aligned tumbling window that holds `ms`."""
    ms = _col(ms)
    return ms - F.pmod(ms, F.lit(size_ms).cast("long"))


def with_windows(
    rows: DataFrame,
    ms: str,
    size_ms: int,
    start: str = "w_start",
    end: str = "w_end",
) -> DataFrame:
    """Assign every row to its one window `[start, end)`."""
    first = window_start(ms, size_ms)
    return rows.withColumns({start: first, end: first + F.lit(size_ms).cast("long")})


def next_instant(ms: Column | str, every_ms: int) -> Column:
    """First multiple of `every_ms` strictly after `ms`."""
    ms = _col(ms)
    return ms - F.pmod(ms, F.lit(every_ms).cast("long")) + F.lit(every_ms).cast("long")


def iso_text(ms: Column | str) -> Column:
    """ISO-8601 text with milliseconds and zone; UTC prints as Z."""
    return F.date_format(F.timestamp_millis(_col(ms)), ISO_FORMAT)


def iso_millis(text: Column | str) -> Column:
    """Epoch milliseconds of ISO-8601 text; null when it is not a time."""
    return F.unix_millis(F.try_to_timestamp(_col(text)))
