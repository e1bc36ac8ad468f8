"""Schemas and fixed values shared by the whole package."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values.
NOT_FOUND = 404  # the only status that means "no such record"
SENTINEL = 0  # "no neighbour on this side"; never a real id

OK = "ok"
MISSING = "missing"
MALFORMED = "malformed"

RESPONSES = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)

RECORD = T.StructType(
    [
        T.StructField("num", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("img", T.StringType()),
        T.StructField("alt", T.StringType()),
        T.StructField("month", T.StringType()),
    ]
)
