"""Job parameters."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class JobConfig:
    """Settings shared by the three jobs; times are in milliseconds."""

    window_ms: int = 20_000
    lateness_ms: int = 5_000
    watermark_delay_ms: int = 10_000
    custom_window_ms: int = 30_000
    early_fire_ms: int = 10_000
    # Longest list put in one output row; a longer window comes in several parts.
    part_rows: int = 100_000
    # Longest list that one task gathers to make the panes of a window and cut them in parts.
    gather_rows: int = 100_000
    # Streaming state is kept per window and bucket of keys; a bucket holds many keys.
    buckets: int = 64
    # Stretches of its time span over which a window's rows are spread, for busy keys.
    slices: int = 1
    # What an allowed-late row sends: "full", the whole list, or "delta", the record.
    refire: str = "full"
    brokers: str = ""
    input_topic: str = "AggregateProspect"
    results_topic: str = "ProspectAggregated"
    late_topic: str = "LateProspect"
    dead_letter_topic: str = "ProspectAggregated-DQL"
    # Registry schema id -> Avro schema text of that writer.
    writer_schemas: dict[int, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.refire not in ("full", "delta"):
            raise ValueError(f"unknown refire mode {self.refire!r}")
        for name in ("window_ms", "custom_window_ms", "early_fire_ms", "part_rows", "gather_rows",
                     "buckets", "slices"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        for name in ("lateness_ms", "watermark_delay_ms"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")
