"""From landed responses to typed records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparsepages.functions.decode import bound_record, filled_record, last_values, lowered_names, parsed_body
from sparsepages.operators.once import computed_once
from sparsepages.schema import MALFORMED, MISSING, NOT_FOUND, OK, RECORD


def _is_found(status: Column) -> Column:
    return ~status.eqNullSafe(NOT_FOUND)


def latest_response(df: DataFrame, key: str | Sequence[str] = "url", version: str = "fetched_at") -> DataFrame:
    """The newest row per key.

    One aggregate: a key landed very often collapses in the map tasks. Rows of
    equal version are told apart by their other columns (a response that was
    found comes before one that was not), so the choice does not depend on the
    order in which rows arrive.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c != version]
    found = [_is_found(F.col("status")).alias("__found")] if "status" in rest else []
    newest = F.max(F.struct(version, *found, *rest)).alias("__newest")
    return df.groupBy(*keys).agg(newest).select(*[c if c in keys else F.col("__newest")[c].alias(c) for c in df.columns])


def filter_existing(df: DataFrame) -> DataFrame:
    """Drop what was not found. Every other status counts as existing."""
    return df.filter(_is_found(F.col("status")))


def blank_missing(df: DataFrame, body: str = "body") -> DataFrame:
    """No body where nothing was found: what says so is long, and nothing reads it."""
    return df.withColumn(body, F.when(_is_found(F.col("status")), F.col(body)))


def existing_ids(responses: DataFrame, key: str = "num", version: str = "fetched_at") -> DataFrame:
    """Distinct ids whose newest landing was found.

    The same choice as ``latest_response`` followed by ``filter_existing``, but
    from three narrow columns and with buffers that a hash aggregate can hold.
    """
    found = _is_found(F.col("status"))
    last = responses.groupBy(key).agg(
        F.max(version).alias("__any"),
        F.max(F.when(found, F.col(version))).alias("__found"),
        F.max(found).alias("__ever"),
    )
    exists = F.when(F.col("__any").isNull(), F.col("__ever")).otherwise(
        F.coalesce(F.col("__found") == F.col("__any"), F.lit(False))
    )
    return last.filter(F.col(key).isNotNull() & exists).select(key)


def decode_records(df: DataFrame, schema: T.StructType = RECORD, body: str = "body") -> DataFrame:
    """Add ``record``, a struct of ``schema``; NULL when the body does not bind to it.

    The text is parsed once for all fields and for every later test of the
    record.
    """
    parsed = (
        df.withColumn("__parsed", parsed_body(F.col(body)))
        .withColumn("__names", lowered_names(F.col("__parsed")))
        .withColumn("__values", last_values(F.col("__parsed")))
    )
    record = bound_record(F.col(body), F.col("__names"), F.col("__values"), schema)
    return computed_once(parsed, "record", record).drop("__parsed", "__names", "__values")


def fill_defaults(df: DataFrame, schema: T.StructType = RECORD) -> DataFrame:
    """Missing numbers in ``record`` become 0; missing strings stay NULL."""
    return df.withColumn("record", filled_record(F.col("record"), schema))


def project_model(df: DataFrame, schema: T.StructType = RECORD, keep: Sequence[str] = ()) -> DataFrame:
    """The record's fields as columns, after those in ``keep``; all else is dropped."""
    return df.select(*keep, *[F.col("record")[name].alias(name) for name in schema.names])


def classify_outcome(df: DataFrame) -> DataFrame:
    """Add ``outcome``: missing (whatever the body says), malformed or ok."""
    outcome = (
        F.when(F.col("status").eqNullSafe(NOT_FOUND), MISSING).when(F.col("record").isNull(), MALFORMED).otherwise(OK)
    )
    return df.withColumn("outcome", outcome)


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split classified rows into the good ones and all others."""
    good = F.col("outcome") == OK
    return df.filter(good), df.filter(~good)
