"""Made-up prospect-company events for load tests, generated on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneflow.schemas import COMPANY_FIELDS

# The constant event.
COMPANY_NAME = "Skynight Inc"
TRADE_LICENSE = "Trd4534rF"
SHARE_HOLDERS = [
    (123, "Cf123", "123456789", "Ada", "Stone", "Ada Stone", False),
    (456, "Cf789", "0987654331", "Ben", "Stone", "Ben Stone", False),
]
# The two load shapes.
ROUND_IDS = 10
ROUND_DELAY_MS = 500
EVENTS_PER_ID = 10
EVENT_SPACING_MS = 2_000
FIRST_ID = 100


def _share_holders() -> Column:
    names = ("id", "cif", "account", "firstName", "lastName", "fullName", "match")
    return F.array(
        *[
            F.struct(
                *[
                    F.lit(v).cast("long").alias(n) if n == "id" else F.lit(v).alias(n)
                    for n, v in zip(names, holder)
                ]
            )
            for holder in SHARE_HOLDERS
        ]
    )


def _company(rows: DataFrame, key: Column, event_ms: Column, *keep: str) -> DataFrame:
    return rows.select(
        *keep,
        key.cast("long").alias("id"),
        F.lit(COMPANY_NAME).alias("companyName"),
        F.lit(TRADE_LICENSE).alias("tradeLicenseNumber"),
        F.lit(False).alias("match"),
        event_ms.cast("long").alias("eventTime"),
        _share_holders().alias("shareHolders"),
    )


def per_id_events(
    ids: DataFrame,
    id_column: str = "id",
    n: int = EVENTS_PER_ID,
    interval_ms: int = EVENT_SPACING_MS,
    base_ms: int = 0,
) -> DataFrame:
    """`n` events, `interval_ms` apart, for each row of `ids`."""
    steps = ids.select(F.col(id_column), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_i"))
    at = F.lit(base_ms).cast("long") + F.col("_i") * F.lit(interval_ms).cast("long")
    return _company(steps, F.col(id_column), at)


def rounds(
    numbers: DataFrame,
    round_column: str = "round",
    ids: int = ROUND_IDS,
    interval_ms: int = ROUND_DELAY_MS,
    base_ms: int = 0,
) -> DataFrame:
    """One event for each id from 0 on in every round, a pause after each event."""
    steps = numbers.select(
        F.col(round_column), F.explode(F.sequence(F.lit(0), F.lit(ids - 1))).alias("_i")
    )
    turn = F.col(round_column) * F.lit(ids).cast("long") + F.col("_i")
    return _company(steps, F.col("_i"), F.lit(base_ms).cast("long") + turn * interval_ms)


def synthetic_events(
    spark: SparkSession,
    n_ids: int,
    n: int = EVENTS_PER_ID,
    interval_ms: int = EVENT_SPACING_MS,
    base_ms: int = 0,
    first_id: int = FIRST_ID,
) -> DataFrame:
    """The per-id load shape for ids counted from `first_id`."""
    return per_id_events(spark.range(first_id, first_id + n_ids), "id", n, interval_ms, base_ms)


def synthetic_stream(
    spark: SparkSession,
    rows_per_batch: int,
    batch_ms: int = EVENT_SPACING_MS,
    ids: int = ROUND_IDS,
    start_ms: int = 0,
) -> DataFrame:
    """Endless stream of constant events, ids taking turns; every micro-batch is
    `batch_ms` of event time further on."""
    ticks = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("startTimestamp", start_ms)
        .option("advanceMillisPerBatch", batch_ms)
        .load()
    )
    return _company(ticks, F.col("value") % ids, F.unix_millis("timestamp")).select(*COMPANY_FIELDS)
