"""Record types of the prospect-company feed."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, types and order are the wire contract.
PROSPECT = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("cif", T.StringType(), False),
        T.StructField("account", T.StringType(), False),
        T.StructField("firstName", T.StringType(), False),
        T.StructField("lastName", T.StringType(), False),
        T.StructField("fullName", T.StringType(), False),
        T.StructField("match", T.BooleanType(), False),
    ]
)

PROSPECT_COMPANY = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("companyName", T.StringType(), False),
        T.StructField("tradeLicenseNumber", T.StringType(), False),
        T.StructField("match", T.BooleanType(), False),
        T.StructField("eventTime", T.LongType(), False),
        T.StructField("shareHolders", T.ArrayType(PROSPECT, False), False),
    ]
)

AGGREGATED_PROSPECT_COMPANY = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("companies", T.ArrayType(PROSPECT_COMPANY, False), False),
    ]
)

COMPANY_FIELDS = tuple(PROSPECT_COMPANY.fieldNames())
# Text fields a hand-written payload may leave out; they become empty strings.
OPTIONAL_SHARE_HOLDER_FIELDS = ("account", "fullName")
