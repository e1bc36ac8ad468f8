"""The per-row operators on live tables.

Decoding, outcomes, routes, rules and the request filters look at one row at a
time, so they run unchanged on a stream; what is here only connects them.
Operators that need a whole collection or a whole time bucket are batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from sparsepages.operators.traffic import exclude_handlers, tag_synthetic
from sparsepages.schema import RESPONSES
from sparsepages.sources.landings import with_ids


def stream_responses(spark: SparkSession, path: str, template: str, fmt: str = "parquet") -> DataFrame:
    """Landed responses as they arrive, with the id taken from each address."""
    return with_ids(spark.readStream.schema(RESPONSES).format(fmt).load(path), template)


def filter_requests(requests: DataFrame) -> DataFrame:
    """Drop requests of listed handlers and tag the synthetic ones among the rest."""
    return tag_synthetic(exclude_handlers(requests))


def append_stream(df: DataFrame, path: str, name: str, fmt: str = "parquet") -> DataStreamWriter:
    """A writer that appends to ``path`` and keeps its progress in the cluster's shared folder.

    The folder is the one the session names in ``spark.checkpoint.dir``.
    """
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("spark.checkpoint.dir is not set")
    progress = f"{folder.rstrip('/')}/streams/{name}"
    return df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", progress).option("path", path)
