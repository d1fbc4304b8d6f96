from paneflow.functions.time import (
    TimeDomain,
    event_millis,
    event_timestamp,
    iso_millis,
    iso_text,
    next_instant,
    stamp_ingestion,
    with_windows,
    window_start,
)

__all__ = [
    "TimeDomain",
    "event_millis",
    "event_timestamp",
    "iso_millis",
    "iso_text",
    "next_instant",
    "stamp_ingestion",
    "with_windows",
    "window_start",
]
