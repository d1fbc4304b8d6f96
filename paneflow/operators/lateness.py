"""What happens to a row depending on how far the watermark has moved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Order matters: within a window a row never has a smaller status than the rows
# that came in before it.
ON_TIME, ALLOWED, LATE = 0, 1, 2


def with_status(
    rows: DataFrame,
    lateness_ms: int,
    wm: str = "wm",
    end: str = "w_end",
    name: str = "status",
) -> DataFrame:
    """On time before the watermark reaches the window's last millisecond,
    allowed for `lateness_ms` after that, late from then on."""
    last = F.col(end) - 1
    return rows.withColumn(
        name,
        F.when(F.col(wm) >= last + F.lit(lateness_ms), LATE)
        .when(F.col(wm) >= last, ALLOWED)
        .otherwise(ON_TIME),
    )


def late_rows(rows: DataFrame, status: str = "status") -> DataFrame:
    return rows.filter(F.col(status) == LATE)


def accepted_rows(rows: DataFrame, status: str = "status") -> DataFrame:
    return rows.filter(F.col(status) != LATE)


def late_count(rows: DataFrame, *by: str, status: str = "status") -> DataFrame:
    """Late-row counter of a recorded stream, one number per `by` group."""
    return late_rows(rows, status).groupBy(*by).agg(F.count(F.lit(1)).alias("late"))
