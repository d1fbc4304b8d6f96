"""WARC archives: writing, reading, and resolving repeated payloads to revisits.

Each input row becomes one record. Headers only, without payloads, are grouped by
payload digest with map-side combine; of equal payloads the record with the largest
id is the original, and the winners are joined back to decide for every record
whether it is written as `response` with its payload or as `revisit` that refers to
the original. A hot digest is one row after the combine, and the join back is an
ordinary shuffled join whose large partitions adaptive execution may split. Payloads
are shuffled once, on their way into the archives. Archives are written through
Spark's own committed text sink, so a lost executor leaves no half-written file, and
on any file system Spark knows.

Defined results: a null payload is empty; a null id sorts below all others; rows
that repeat the largest id of their payload are all written as `response`, since they
are copies of the original record; a null URI has no target header; line breaks and
other controls in a URI are percent-encoded. Payloads below `min_bytes` are always
`response`. An empty table gives archives without records, which read back as none.
Other columns of the input take no part.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneflow.session import shared_folder

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
EMPTY_DATE = "1970-01-01T00:00:00Z"
# Base 32: digits of base conversion, and the alphabet of RFC 4648.
_DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_RFC4648 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

READ_SCHEMA = (
    "record_id string, record_type string, target_uri string, source_id long, "
    "payload_digest string, refers_to_id string, payload_bytes long, payload binary, "
    "intact boolean"
)


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base-32 SHA-1."""
    digits = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.translate(F.concat(*parts), _DIGITS32, _RFC4648)


def records_of(rows: DataFrame, id_col: str, uri_col: str, payload_col: str) -> DataFrame:
    """Record columns of a table of captured pages."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    uri = F.regexp_replace(F.col(uri_col).cast("string"), r"\r", "%0D")
    uri = F.regexp_replace(uri, r"\n", "%0A")
    uri = F.regexp_replace(uri, r"[\x00-\x20\x7F]", "%20")
    named = rows.select(
        F.col(id_col).cast("long").alias("source_id"), uri.alias("uri"), payload.alias("payload")
    )
    named = named.withColumns(
        {"digest": payload_digest(F.col("payload")), "bytes": F.octet_length("payload")}
    )
    name = F.md5(F.concat_ws("|", F.col("source_id").cast("string"), "uri", "digest"))
    uuid = F.regexp_replace(name, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return named.withColumn("record_id", F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">")))


def resolve_revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add `original`, the header of the record that each record revisits, or null
    for the records that are originals themselves."""
    header = F.struct("source_id", "uri", "record_id")
    originals = (
        records.filter(F.col("bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.max(header).alias("original"), F.count(F.lit(1)).alias("_copies"))
        .filter(F.col("_copies") > 1)
        .select("digest", "original")
    )
    joined = records.join(originals, "digest", "left")
    itself = F.col("source_id").eqNullSafe(F.col("original.source_id"))
    small = F.col("bytes") < min_bytes
    return joined.withColumn("original", F.when(itself | small, None).otherwise(F.col("original")))


def record_text(date: str = EMPTY_DATE) -> Column:
    """One record, with fresh headers, up to but without the two closing line ends."""
    revisit = F.col("original").isNotNull()

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    length = F.when(revisit, F.lit(len(HTTP_HEAD))).otherwise(F.col("bytes") + len(HTTP_HEAD))
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Source-ID", F.col("source_id").cast("string")),
        line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        line("WARC-Refers-To", F.col("original.record_id")),
        line("WARC-Refers-To-Target-URI", F.col("original.uri")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
    )
    body = F.when(revisit, F.lit(HTTP_HEAD)).otherwise(F.concat(F.lit(HTTP_HEAD), "payload"))
    return F.concat(head, body)


def write_archives(
    resolved: DataFrame,
    path: str,
    date: str = EMPTY_DATE,
    compression: str = "gzip",
    records_per_file: int = 50_000,
) -> None:
    """Write resolved records as archive files below `path`, one per task and
    `records_per_file` records."""
    (
        resolved.select(record_text(date).alias("value"))
        .write.option("lineSep", "\r\n\r\n")
        .option("compression", compression)
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of one archive file,
    plain or compressed as one or many gzip members."""
    stream = io.BytesIO(content)
    if content[:2] == b"\x1f\x8b":
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20)
    while version := stream.readline():
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {version[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError("the archive ends inside a record")
        yield headers, block


def _record_row(headers: dict[str, str], block: bytes, keep_payload: bool) -> tuple:
    http = headers.get("content-type", "").startswith("application/http")
    payload = block.partition(b"\r\n\r\n")[2] if http else block
    kind, digest = headers["warc-type"], headers.get("warc-payload-digest", "")
    digest = digest.removeprefix("sha1:")
    source = headers.get("warc-source-id")
    if kind == "revisit":
        size, intact, payload = None, None, None
    else:
        size = len(payload)
        intact = base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest
    return (
        headers["warc-record-id"],
        kind,
        headers.get("warc-target-uri"),
        int(source) if source is not None else None,
        digest,
        headers.get("warc-refers-to"),
        size,
        payload if keep_payload else None,
        intact,
    )


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """Records of all archive files below `path`. `intact` tells whether a
    response's payload has the digest its header states."""
    names = [f.split(" ")[0] for f in READ_SCHEMA.split(", ")]
    kinds = pa.schema(
        zip(
            names,
            [pa.string()] * 3 + [pa.int64()] + [pa.string()] * 2
            + [pa.int64(), pa.binary(), pa.bool_()],
        )
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for content in batch.column("content"):
                for headers, block in parse_archive(content.as_py()):
                    rows.append(_record_row(headers, block, keep_payload))
                    held += len(block) if keep_payload else 0
                    if len(rows) >= 10_000 or held > 16 << 20:
                        yield _batch(rows, kinds)
                        rows, held = [], 0
        if rows:
            yield _batch(rows, kinds)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, READ_SCHEMA)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def joined_revisits(records: DataFrame) -> DataFrame:
    """Records as read, each revisit completed from the response it refers to:
    `payload_bytes`, and `refers_to`, the source id of the response."""
    originals = (
        records.filter(F.col("record_type") == "response")
        .groupBy(F.col("record_id").alias("refers_to_id"))
        .agg(F.max("payload_bytes").alias("_bytes"), F.max("source_id").alias("_source"))
    )
    revisits = records.filter(F.col("record_type") == "revisit").join(
        originals, "refers_to_id", "left"
    )
    completed = revisits.withColumns(
        {"payload_bytes": F.col("_bytes"), "refers_to": F.col("_source")}
    ).drop("_bytes", "_source")
    others = records.filter(F.col("record_type") != "revisit")
    return others.withColumn("refers_to", F.lit(None).cast("long")).unionByName(completed)


def deduplicate(
    rows: DataFrame,
    id_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    path: str | None = None,
) -> str:
    """Write the rows as archives in which each payload is stored once; returns the
    folder of the archives."""
    path = path or shared_folder(rows.sparkSession, "warc")
    records = records_of(rows, id_col, uri_col, payload_col)
    write_archives(resolve_revisits(records, min_bytes), path)
    return path
