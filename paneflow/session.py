"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: event times are epoch based and text is UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def small_batches(spark: SparkSession, rows: int = 500) -> SparkSession:
    """Let few rows at a time travel to and from Python, and leave a Parquet file.

    Spark holds a batch outside its heap, and twice while the batch grows; the worker holds
    it again. At 10,000 rows, Spark's default, a batch of texts takes some tens of MB per
    task, and one of pairs of texts twice that. Results do not depend on it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(rows))
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new sub-folder of the cluster's shared checkpoint folder.

    Only a session that names no such folder, as in a local test, gets a
    temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.sparkContext.getCheckpointDir()
    if root is None:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="paneflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
