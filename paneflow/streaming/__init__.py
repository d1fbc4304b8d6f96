from paneflow.streaming.jobs import (
    custom_window_stream,
    event_time_stream,
    fast_event_time_stream,
    fast_ingestion_time_stream,
    ingestion_time_stream,
    prepare,
)
from paneflow.streaming.replay import Replay, replay
from paneflow.streaming.sinks import (
    LateCounter,
    count_late,
    dead_letter_messages,
    kafka_messages,
    kafka_sender,
    result_messages,
    start_console,
    start_messages,
    start_results,
)
from paneflow.streaming.table import ResultTable

__all__ = [
    "LateCounter",
    "Replay",
    "ResultTable",
    "count_late",
    "custom_window_stream",
    "dead_letter_messages",
    "event_time_stream",
    "fast_event_time_stream",
    "fast_ingestion_time_stream",
    "ingestion_time_stream",
    "kafka_messages",
    "kafka_sender",
    "prepare",
    "replay",
    "result_messages",
    "start_console",
    "start_messages",
    "start_results",
]
