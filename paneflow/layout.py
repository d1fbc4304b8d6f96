"""Which columns of a DataFrame play which part in a windowed aggregation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """Column roles, so that every operator works on any table.

    keys      grouping key columns
    event_ms  event time, epoch milliseconds (long)
    arrival   columns giving the total order in which rows came in; the first is
              the arrival clock in epoch milliseconds (a second numeric one, when
              there is one, is used to split a crowded millisecond)
    record    columns that make up the delivered record; two rows are copies of
              each other when all of these are equal
    """

    keys: tuple[str, ...]
    event_ms: str
    arrival: tuple[str, ...]
    record: tuple[str, ...]

    def arrival_struct(self, *carry: str) -> Column:
        """Arrival order as one comparable struct; `carry` columns ride along."""
        return F.struct(*[F.col(c) for c in (*self.arrival, *carry)])

    def record_struct(self) -> Column:
        return F.struct(*[F.col(c) for c in self.record])
