"""What the operators share: scratch space, broadcast by size, Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

BROADCAST_BYTES = 32_000_000
ROWS_IN_BATCH = 1000  # texts that an Arrow batch brings to a Python worker
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; where it is unset and all runs on this machine, as in tests, one of its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="sparsepages-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()).rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """``df`` computed once, kept in the shared folder, with its lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def narrow(df: DataFrame, rows: int = 1 << 17) -> DataFrame:
    """``df``, settled, in no more partitions than one for each ``rows`` rows: what follows writes a file per partition, however small."""
    kept = settle(df)
    return kept.coalesce(1 + kept.count() // rows)


def if_small(df: DataFrame, row_bytes: int | Column = 64) -> DataFrame:
    """``df``, marked for broadcast only if its rows hold no more than ``BROADCAST_BYTES``; beyond that the join shuffles.

    ``row_bytes`` is what a row takes: a number for narrow rows, else a column.
    """
    size = F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes)
    return F.broadcast(df) if (df.agg(size).first()[0] or 0) <= BROADCAST_BYTES else df


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of ``ROWS_IN_BATCH`` rows, for whole texts; a size that the session was given stays."""
    if int(spark.conf.get(_BATCH_SETTING)) == 10_000:  # Spark's own
        spark.conf.set(_BATCH_SETTING, ROWS_IN_BATCH)


def texts_of(batch, name: str = "text") -> list[str]:
    """The texts of an Arrow batch, null as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def whole_ids(docs: DataFrame, name: str = "doc_id") -> Column:
    """The ids as 64-bit numbers; other kinds of ids are refused."""
    if not isinstance(docs.schema[name].dataType, IntegralType):
        raise ValueError(f"{name} must be a whole number, not {docs.schema[name].dataType.simpleString()}")
    return F.col(name).cast("bigint")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id and text hash are in ``gone`` (``gone_id, gone_hash``)."""
    rows = docs.select(F.struct("*").alias("doc"))
    few = if_small(settle(gone.distinct()))
    same = F.col("doc.doc_id").eqNullSafe(F.col("gone_id")) & F.xxhash64("doc.text").eqNullSafe(F.col("gone_hash"))
    return rows.join(few, same, "left_anti").select("doc.*")
