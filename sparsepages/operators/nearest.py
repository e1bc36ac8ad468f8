"""Next and previous existing id over one huge, sparse, ordered collection.

A plain ``lead``/``lag`` over all ids sorts them in a single task. Here ids are
cut into buckets of ``2**bucket_bits`` consecutive values. Ids are distinct, so
a bucket cannot hold more rows than that, however uneven the collection is.
Neighbours inside a bucket come from a window per bucket; those across a bucket
edge come from a table with one row per non-empty bucket, which is itself cut
into blocks of ``2**STEP_BITS`` until at most ``2**TOP_BITS`` rows can be left,
which the type of the ids decides: one such level for 64-bit ids, none for
32-bit ones. Only that last, bounded step is a window without partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparsepages.schema import SENTINEL

BUCKET_BITS = 22
STEP_BITS = 21
TOP_BITS = 20


def end_sentinel(neighbour: Column, sentinel: int | None = SENTINEL) -> Column:
    """Mark "no neighbour" with the sentinel; ``None`` leaves it NULL."""
    return neighbour if sentinel is None else F.coalesce(neighbour, F.lit(sentinel))


def _key_bits(df: DataFrame, key: str) -> int:
    kind = df.schema[key].dataType
    widths = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}
    if type(kind) not in widths:
        raise ValueError(f"ids must be whole numbers, not {kind.simpleString()}")
    return widths[type(kind)]


def _outside(blocks: DataFrame, by: list[str], order: str) -> DataFrame:
    """Add the highest id of all earlier blocks and the lowest of all later ones.

    Both frames only grow, so each is one pass over a sorted group; a frame
    reaching from the current row to the end would be re-read for every row.
    """
    before = Window.partitionBy(*by).orderBy(F.col(order)).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*by).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("__prev", F.max("__hi").over(before)).withColumn("__next", F.min("__lo").over(after))


def _carry(blocks: DataFrame, by: list[str], bits: int) -> DataFrame:
    """``blocks`` has one row per non-empty block: its number, lowest and highest id."""
    if bits <= TOP_BITS:
        return _outside(blocks, by, "__block").select(*by, "__block", "__prev", "__next")
    inner = _outside(blocks.withColumn("__upper", F.shiftright("__block", STEP_BITS)), [*by, "__upper"], "__block")
    upper = blocks.groupBy(*by, F.shiftright("__block", STEP_BITS).alias("__block")).agg(
        F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi")
    )
    far = _carry(upper, by, bits - STEP_BITS)
    return _add_carry(inner, far, by, "__upper").select(*by, "__block", "__prev", "__next")


def _add_carry(rows: DataFrame, carry: DataFrame, by: list[str], block: str) -> DataFrame:
    """Fill the neighbours still missing at the edges of a block.

    ``rows`` is already partitioned and sorted by block from its window, so of
    the two sides only the small one moves.
    """
    renames = {"__block": "__far_block", "__prev": "__far_prev", "__next": "__far_next"}
    far = carry.select(*[F.col(c).alias(renames.get(c, f"__far_{c}")) for c in carry.columns])
    same = F.col(block) == F.col("__far_block")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__far_{c}"))
    joined = rows.join(far, same, "left")
    for c in ("__prev", "__next"):
        joined = joined.withColumn(c, F.coalesce(c, c.replace("__", "__far_")))
    return joined.select(*rows.columns)


def _above(ids: DataFrame, key: str, floor: int | None) -> DataFrame:
    return ids.filter(F.col(key).isNotNull() if floor is None else F.col(key) > floor)


def neighbours(
    ids: DataFrame,
    key: str = "num",
    by: Sequence[str] = (),
    sentinel: int | None = SENTINEL,
    floor: int | None = SENTINEL,
    unique: bool = False,
    bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """Each existing id with its ``next_page`` and ``prev_page``.

    ``by`` makes one sequence per group. Ids up to ``floor`` do not exist.
    ``unique`` skips the de-duplication when the caller knows there is nothing
    to remove.
    """
    by = list(by)
    bits = _key_bits(ids, key)
    keys = _above(ids.select(*by, key), key, floor)
    block = F.shiftright(key, bucket_bits).alias("__block")
    blocks = keys.groupBy(*by, block).agg(F.min(key).alias("__lo"), F.max(key).alias("__hi"))
    carry = _carry(blocks, by, bits - bucket_bits)

    rows = keys if unique else keys.distinct()
    rows = rows.select("*", block)
    inside = Window.partitionBy(*by, "__block").orderBy(key)
    rows = rows.withColumn("__next", F.lead(key).over(inside)).withColumn("__prev", F.lag(key).over(inside))
    return _add_carry(rows, carry, by, "__block").select(
        *by,
        key,
        end_sentinel(F.col("__next"), sentinel).alias("next_page"),
        end_sentinel(F.col("__prev"), sentinel).alias("prev_page"),
    )


def next_existing(ids: DataFrame, key: str = "num", by: Sequence[str] = (), **options) -> DataFrame:
    """Each existing id with the nearest larger one."""
    return neighbours(ids, key, by, **options).drop("prev_page")


def prev_existing(ids: DataFrame, key: str = "num", by: Sequence[str] = (), **options) -> DataFrame:
    """Each existing id with the nearest smaller one."""
    return neighbours(ids, key, by, **options).drop("next_page")


def neighbours_of(
    probes: DataFrame,
    ids: DataFrame,
    key: str = "num",
    by: Sequence[str] = (),
    sentinel: int | None = SENTINEL,
    floor: int | None = SENTINEL,
    bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """The existing neighbours of any id, itself existing or not; one row per distinct probe."""
    by = list(by)
    bits = _key_bits(ids, key)
    marked = (
        _above(ids.select(*by, key), key, floor)
        .withColumn("__exists", F.lit(True))
        .unionByName(probes.select(*by, key).filter(F.col(key).isNotNull()).withColumn("__exists", F.lit(False)))
        .withColumn("__id", F.when(F.col("__exists"), F.col(key)))
    )
    block = F.shiftright(key, bucket_bits).alias("__block")
    blocks = marked.groupBy(*by, block).agg(F.min("__id").alias("__lo"), F.max("__id").alias("__hi"))
    carry = _carry(blocks, by, bits - bucket_bits)

    rows = marked.groupBy(*by, key).agg(F.max("__id").alias("__lo"), F.min("__exists").alias("__only_exists"))
    rows = _outside(rows.select("*", block, F.col("__lo").alias("__hi")), [*by, "__block"], key)
    # Existing ids nobody asked about have done their part in the windows.
    return (
        _add_carry(rows, carry, by, "__block")
        .filter(~F.col("__only_exists"))
        .select(
            *by,
            key,
            end_sentinel(F.col("__next"), sentinel).alias("next_page"),
            end_sentinel(F.col("__prev"), sentinel).alias("prev_page"),
        )
    )


def largest_id(ids: DataFrame, key: str = "num") -> Column:
    """The largest id as a scalar subquery."""
    return ids.agg(F.max(key)).scalar()


def clip_next(next_page: Column, last: Column | int, sentinel: int | None = SENTINEL) -> Column:
    """The search for a next id ends at ``last``; what lies beyond is no neighbour."""
    return end_sentinel(F.when(next_page <= last, next_page), sentinel)


def bounded_walk(ids: DataFrame, last: Column | int | None = None, key: str = "num", **options) -> DataFrame:
    """Next existing id up to ``last`` (a number or a scalar subquery; default the largest id)."""
    bound = largest_id(ids, key) if last is None else last
    sentinel = options.get("sentinel", SENTINEL)
    steps = next_existing(ids, key, **options)
    return steps.withColumn("next_page", clip_next(F.col("next_page"), bound, sentinel))


def missing_ids(candidates: DataFrame, ids: DataFrame, key: str = "num") -> DataFrame:
    """The candidates that do not exist, each once.

    Repeated ids are combined before they move, and both sides leave their
    aggregate partitioned for the join.
    """
    wanted = candidates.select(key).filter(F.col(key).isNotNull()).distinct()
    return wanted.join(ids.select(key).distinct(), key, "left_anti")


def gap_runs(ids: DataFrame, key: str = "num", **options) -> DataFrame:
    """Every hole between two existing ids: its first and last id and its length."""
    steps = next_existing(ids, key, **{**options, "sentinel": None})
    gap = F.col("next_page") - F.col(key)
    return steps.filter(gap > 1).select(
        *options.get("by", ()),
        (F.col(key) + 1).alias("gap_start"),
        (F.col("next_page") - 1).alias("gap_end"),
        (gap - 1).alias("skipped"),
    )
