"""A join to a one-row-per-key table that no frequent key can slow down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# One row in this many decides which keys are frequent.
_PROBE = 64


def join_unique(
    rows: DataFrame,
    table: DataFrame,
    on: str,
    split_by: list[str] | None = None,
    how: str = "left",
    pieces: int = 4096,
) -> DataFrame:
    """Join ``rows`` to ``table``, which has one row per ``on``.

    A key holding more than 1/``pieces`` of all rows is dealt out over several
    join keys, and its single table row is repeated once per part. There are
    fewer than ``pieces`` such keys whatever the size of the data, which is what
    makes broadcasting their list safe. NULL keys match nothing and are spread
    in the same way.

    ``split_by`` names columns that tell the rows of one key apart: their hash
    deals the rows, and frequencies are estimated from the rows whose hash falls
    into one of ``_PROBE`` classes, the same ones on every run. Without it rows
    may be equal: they are dealt by all their columns and the input partition
    they come from, and frequencies are counted. Either only decides how a key
    is split; every row takes part in the join, and any part of a key finds the
    same table row.
    """
    known = F.col(on).isNotNull()
    if split_by is None:
        rows = rows.withColumn("__mark", F.xxhash64(*rows.columns, F.spark_partition_id()))
        sizes = rows.filter(known).groupBy(on).agg(F.count("*").alias("n"))
    else:
        rows = rows.withColumn("__mark", F.xxhash64(*split_by))
        probe = rows.filter(known & (F.pmod(F.shiftright("__mark", 32), F.lit(_PROBE)) == 0))
        sizes = probe.groupBy(on).agg((F.count("*") * _PROBE).alias("n"))
    share = sizes.agg(F.expr(f"greatest(1L, (sum(n) + {pieces - 1}) div {pieces})")).scalar()
    frequent = (
        sizes.withColumn("__share", share)
        .filter("n > __share")
        .select(on, F.expr("(n + __share - 1) div __share").alias("__parts"))
    )
    mark = F.col("__mark")
    part = F.when(F.col("__parts").isNotNull(), F.pmod(mark, F.col("__parts"))).when(~known, F.pmod(mark, F.lit(pieces)))
    dealt = (
        rows.join(F.broadcast(frequent), on, "left")
        .withColumn("__part", F.coalesce(part, F.lit(0)).cast("int"))
        .drop("__parts", "__mark")
    )
    parts = F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)).cast("int") - 1)
    repeated = table.join(F.broadcast(frequent), on, "left").withColumn("__part", F.explode(parts)).drop("__parts")
    return dealt.join(repeated, [on, "__part"], how).drop("__part")
