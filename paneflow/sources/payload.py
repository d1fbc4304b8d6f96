"""Decoding of event payloads and the split into good rows and dead letters."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneflow.functions.time import iso_millis
from paneflow.schemas import OPTIONAL_SHARE_HOLDER_FIELDS, PROSPECT, PROSPECT_COMPANY

MALFORMED = "malformed payload"
MISSING = "missing required field: "
NO_HEADER = "no registry header"
UNKNOWN_SCHEMA = "unknown schema id: "
_CORRUPT = "_corrupt"
# Where a row came from; a dead letter carries these when the input has them.
ORIGIN = {"topic": "string", "partition": "int", "offset": "bigint"}


def _nullable(dtype: T.DataType) -> T.DataType:
    """The same type with every field optional, as a parser needs it."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in dtype])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_nullable(dtype.elementType))
    return dtype


def _once(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a costly column so that it is computed once per row. As a generated
    column it is not copied into every expression and filter that reads it."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _is_null(field: str) -> Callable[[Column], Column]:
    return lambda element: element[field].isNull()


def _missing(value: Column, dtype: T.DataType, path: str) -> list[tuple[str, Column]]:
    """Checks, per required field, that say whether it is null."""
    found: list[tuple[str, Column]] = []
    if isinstance(dtype, T.StructType):
        for f in dtype:
            name = f"{path}.{f.name}" if path else f.name
            if not f.nullable:
                found.append((name, value[f.name].isNull()))
            found += _missing(value[f.name], f.dataType, name)
    elif isinstance(dtype, T.ArrayType):
        if not dtype.containsNull:
            found.append((f"{path}[]", F.exists(value, lambda e: e.isNull())))
        if isinstance(dtype.elementType, T.StructType):
            for f in dtype.elementType:
                if not f.nullable:
                    found.append((f"{path}[].{f.name}", F.exists(value, _is_null(f.name))))
    return found


def required_fields(schema: T.StructType, value: Column) -> Column:
    """Comma-separated names of required fields that are null; empty when none is."""
    names = [
        F.when(F.coalesce(is_null, F.lit(False)), F.lit(name))
        for name, is_null in _missing(value, schema, "")
    ]
    return F.concat_ws(", ", *names) if names else F.lit("")


def parse_json(
    rows: DataFrame, schema: T.StructType, value: str = "value", name: str = "rec"
) -> DataFrame:
    """Decode a JSON text column into `name` and say in `reason` what is wrong
    with the row; a good row has a null reason."""
    wanted = _nullable(schema)
    shape = T.StructType([*wanted.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = _once(rows, F.from_json(F.col(value).cast("string"), shape, options), "_parsed")
    rec = F.struct(*[F.col("_parsed")[f].alias(f) for f in schema.fieldNames()])
    bad = F.col("_parsed").isNull() | F.col(f"_parsed.{_CORRUPT}").isNotNull()
    return _with_reason(parsed, bad, rec, schema, name).drop("_parsed")


def _with_reason(
    rows: DataFrame, bad: Column, rec: Column, schema: T.StructType, name: str
) -> DataFrame:
    rows = _once(rows, F.struct(rec.alias("rec"), bad.alias("bad")), "_checked")
    missing = required_fields(schema, F.col("_checked.rec"))
    reason = F.when(F.col("_checked.bad"), F.lit(MALFORMED)).when(
        missing != "", F.concat(F.lit(MISSING), missing)
    )
    rows = rows.withColumns({name: F.col("_checked.rec"), "reason": reason})
    return rows.drop("_checked")


def parse_company_json(rows: DataFrame, value: str = "value", name: str = "rec") -> DataFrame:
    """Decode prospect-company payloads written by hand or by a program: the
    event time is epoch milliseconds or ISO-8601 text, and share holders may
    leave out account and full name."""
    loose = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name == "eventTime" else f.dataType, True)
            for f in PROSPECT_COMPANY
        ]
    )
    # Field checks follow once the event time is a number.
    parsed = parse_json(rows, _nullable(loose), value, "_loose")
    millis = F.coalesce(
        F.col("_loose.eventTime").try_cast("bigint"), iso_millis("_loose.eventTime")
    )

    def holder(h: Column) -> Column:
        fields = [
            F.coalesce(h[f], F.lit("")).alias(f)
            if f in OPTIONAL_SHARE_HOLDER_FIELDS
            else h[f].alias(f)
            for f in PROSPECT.fieldNames()
        ]
        return F.when(h.isNotNull(), F.struct(*fields))

    columns = {
        "eventTime": millis,
        "shareHolders": F.transform("_loose.shareHolders", holder),
    }
    rec = F.struct(
        *[
            columns.get(f, F.col(f"_loose.{f}")).alias(f)
            for f in PROSPECT_COMPANY.fieldNames()
        ]
    )
    bad = F.col("reason").isNotNull()
    return _with_reason(parsed, bad, rec, PROSPECT_COMPANY, name).drop("_loose")


def decode_registry(
    rows: DataFrame,
    decoders: Mapping[int, Callable[[Column], Column]],
    schema: T.StructType,
    payload: str = "payload",
    name: str = "rec",
) -> DataFrame:
    """Decode registry-framed values, `schema_id` and `payload` as given by
    `registry_payload`. Each row goes to the decoder of the schema it was written with, and
    every decoder gives a record of the one reader `schema`, missing fields null.

    A row without a header or with an id that no decoder knows gets a reason of its own, and
    so do payloads that do not decode (no record, or one without any value) and records that
    lack a required field.
    """
    if not decoders:
        raise ValueError("no writer schema is known")
    wanted = _nullable(schema)
    own, tries = F.col("schema_id"), F.lit(None).cast(wanted)
    for schema_id, decode in decoders.items():
        fields = decode(F.col(payload))
        tries = F.when(own == schema_id, fields).otherwise(tries)
    rows = _once(rows, tries, "_parsed")
    rec = F.struct(*[F.col("_parsed")[f].alias(f) for f in schema.fieldNames()])
    empty = F.lit(True)
    for field in schema.fieldNames():
        empty = empty & F.col("_parsed")[field].isNull()
    decoded = _with_reason(rows, F.col("_parsed").isNull() | empty, rec, schema, name)
    known = own.isin(*decoders)
    reason = (
        F.when(own.isNull(), F.lit(NO_HEADER))
        .when(~known, F.concat(F.lit(UNKNOWN_SCHEMA), own.cast("string")))
        .otherwise(F.col("reason"))
    )
    return decoded.withColumn("reason", reason).drop("_parsed")


def avro_decoders(
    writer_schemas: Mapping[int, str], reader_schema: str | None = None
) -> dict[int, Callable[[Column], Column]]:
    """Decoders of Avro payloads for `decode_registry`, resolved to the reader schema. Needs
    Spark's Avro package on the session's class path."""
    from pyspark.sql.avro.functions import from_avro

    options = {"mode": "PERMISSIVE"}
    if reader_schema is not None:
        options["avroSchema"] = reader_schema
    return {
        schema_id: (lambda value, text=text: from_avro(value, text, options))
        for schema_id, text in writer_schemas.items()
    }


def parse_avro(
    rows: DataFrame,
    writer_schemas: Mapping[int, str],
    schema: T.StructType,
    reader_schema: str | None = None,
    name: str = "rec",
) -> DataFrame:
    """Decode registry-framed Avro with the schema each row was written with."""
    if not writer_schemas:
        raise ValueError("no writer schema is known")
    return decode_registry(rows, avro_decoders(writer_schemas, reader_schema), schema, name=name)


def split_valid(parsed: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Good rows, and dead letters with reason, raw payload and origin."""
    good = parsed.filter(F.col("reason").isNull()).drop("reason")
    origin = [
        (F.col(c) if c in parsed.columns else F.lit(None)).cast(t).alias(c)
        for c, t in ORIGIN.items()
    ]
    dead = parsed.filter(F.col("reason").isNotNull()).select(
        "reason", F.col(value).cast("binary").alias("value"), *origin
    )
    return good, dead


def company_columns(good: DataFrame, rec: str = "rec") -> DataFrame:
    """Record fields as columns, beside whatever else the row carries."""
    return good.select("*", f"{rec}.*").drop(rec)
