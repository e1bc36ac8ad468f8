"""Addresses of numbered records, and the landed responses behind them.

A fetcher outside Spark lands one row per response; everything here is narrow
and works on files of any number and size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparsepages.schema import RESPONSES

_SLOT = "{0}"


def _split_template(template: str) -> tuple[str, str]:
    if template.count(_SLOT) != 1:
        raise ValueError(f"address template needs exactly one {_SLOT}: {template!r}")
    before, after = template.split(_SLOT)
    return before, after


def url_for(num: Column, template: str) -> Column:
    """Address of ``num``; NULL stays NULL.

    ``concat`` rather than ``format_string``: same text, no formatter per row.
    """
    before, after = _split_template(template)
    return F.concat(F.lit(before), num.cast("string"), F.lit(after))


def expand_urls(df: DataFrame, template: str, key: str = "num", out: str = "url") -> DataFrame:
    """Fill each id into the address template."""
    return df.withColumn(out, url_for(F.col(key), template))


def candidate_ids(spark: SparkSession, low: int, high: int, key: str = "num") -> DataFrame:
    """Every id from ``low`` to ``high``, both included, spread over the cluster."""
    return spark.range(low, high + 1).withColumnRenamed("id", key)


def with_ids(responses: DataFrame, template: str, key: str = "num") -> DataFrame:
    """Read the id back out of the address; NULL where the address is not that of any id.

    Cut out, convert, and compare with the address rebuilt: an id has exactly
    one address, and no pattern is matched per row.
    """
    before, after = _split_template(template)
    length = F.length("url") - len(before) - len(after)
    num = F.substring(F.col("url"), F.lit(len(before) + 1), length).try_cast("bigint")
    return responses.withColumn(key, F.when(url_for(num, template) == F.col("url"), num))


def read_responses(spark: SparkSession, path, fmt: str = "parquet") -> DataFrame:
    """Landed responses under the fixed schema; nothing is inferred."""
    return spark.read.schema(RESPONSES).format(fmt).load(path)


def scan_responses(spark: SparkSession, path, template: str, fmt: str = "parquet") -> DataFrame:
    """Landed responses with the id taken from each address."""
    return with_ids(read_responses(spark, path, fmt), template)
