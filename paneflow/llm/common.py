"""Helpers that several training-data operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneflow.session import shared_folder

# Words are separated by space and the five ASCII controls 0x09-0x0D only.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` to the folder all executors share and read it back.

    Cuts lineage, so that a lost executor never causes earlier steps to run again.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def n_words(text: Column) -> Column:
    """Number of words of a text that is not null."""
    cut = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(cut == "", F.lit(0)).otherwise(F.size(F.split(cut, rf"{SPACE}+"))).cast("long")


def total_bytes(df: DataFrame, text: str = "text") -> int:
    """Bytes of text in the table: one pass over one column, one number back."""
    return df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def text_blocks(n_bytes: int, block_bytes: int, least: int = 1) -> int:
    """How many blocks hold `n_bytes` when each gets about `block_bytes`."""
    return max(least, -(-n_bytes // block_bytes))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pack(table: pa.Table) -> bytes:
    """A table as one compressed value, to travel as a single row."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def unpack(value: bytes) -> pa.Table:
    return pa.ipc.open_stream(value).read_all()


def pack_strings(strings: list[bytes]) -> bytes:
    """Byte strings as one compressed value; sorted ones take a few bytes each."""
    lengths = np.array([len(strings), *map(len, strings)], dtype="<u4").tobytes()
    return zstandard.ZstdCompressor(level=6).compress(lengths + b"".join(strings))


def unpack_strings(value: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = np.cumsum(np.frombuffer(raw, "<u4", n + 1)[1:]) + 4 * (n + 1)
    starts = [4 * (n + 1), *ends[:-1].tolist()]
    return [raw[a:b] for a, b in zip(starts, ends.tolist())]


def numbered_blocks(
    batches: Iterable[pa.RecordBatch], block_bytes: int
) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Number the blocks of a task; a block is a run of rows whose second column, a text,
    has about `block_bytes`."""
    part = TaskContext.get().partitionId()
    held, size, number = [], 0, 0
    for batch in batches:
        lengths = np.asarray(
            pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
        )
        start = 0
        for i, length in enumerate(lengths):
            size += int(length)
            if size >= block_bytes:
                held.append(batch.slice(start, i + 1 - start))
                yield (part << 32) | number, held
                held, size, number, start = [], 0, number + 1, i + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield (part << 32) | number, held


def packed_blocks(texts: DataFrame, block_bytes: int) -> DataFrame:
    """`block` and `packed`: the rows of each block as one compressed value."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in numbered_blocks(batches, block_bytes):
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([pack(pa.Table.from_batches(rows))], pa.binary())],
                ["block", "packed"],
            )

    return texts.mapInArrow(packed, "block long, packed binary")


def few_at_a_time(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in small slices, so that few texts at a time become Python strings;
    memory that Arrow no longer needs is given back in between."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
        pa.default_memory_pool().release_unused()
