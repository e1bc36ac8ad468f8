"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import if_small, settle

SLICES = 4096  # slices of a range of keys
SORTED_ROWS = 1 << 16  # a slice with no more rows is sorted in one task
MOST_LEVELS = 4  # of slices within slices: 2**48 in all
MOST_EPOCHS = 3
SEED = 20240607
_SPACE = r"[\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of runs other than ASCII white space; 0 for null."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{_SPACE}|{_SPACE}\z", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, _SPACE))).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_EPOCHS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row per source.

    Sources in code-point order, null last, take the weights in turn. A target is
    ``least(most * source_size, level * weight)`` with the level at which the
    targets add up to all sizes: what a full source cannot take is shared by the
    others. The level follows from the sources in the order in which they fill up.
    The windows see one row per source.
    """
    in_turn = F.array(*map(F.lit, weights))[F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))]
    weighed = sizes.withColumn("weight", in_turn.cast("double")).withColumn("most", F.lit(float(most)) * F.col("source_size"))
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    staged = (
        weighed.withColumn("left_size", F.sum("source_size").over(everything) - F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("left_size", F.coalesce("left_size", F.sum("source_size").over(everything).cast("double")))
        .withColumn("left_weight", F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", F.col("left_size") / F.col("left_weight"))
    )
    # The first source that is not full at its level sets the level for it and all later ones.
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), "source", "level"))).over(everything)
    return staged.withColumn("target", F.least(F.col("most"), level["level"] * F.col("weight"))).select("source", "source_size", "target")


def _keyed(docs: DataFrame, quality: DataFrame | None, *payload: Column) -> DataFrame:
    """``payload, doc_id, size, key, same`` of every row; ``same`` is the source, comparable also where it is null."""
    unit = (F.pmod(F.xxhash64("doc_id", "text", F.lit(SEED)), F.lit(1 << 53)) + 0.5) / float(1 << 53)
    same = F.struct(F.col("source").alias("source"))
    sized = docs.select(*(p.alias("payload") for p in payload), "doc_id", same.alias("same"), n_words(F.col("text")).alias("size"), unit.alias("unit"))
    if quality is None:
        sized = sized.withColumn("weight", F.lit(1.0))
    else:
        marks = settle(quality.filter("doc_id is not null").select(F.col("doc_id").alias("marked"), F.col("weight").cast("double").alias("weight")))
        sized = sized.join(if_small(marks), F.col("doc_id") == F.col("marked"), "left").drop("marked")
    key = -F.log("unit") / F.greatest(F.coalesce("weight", F.lit(1.0)), F.lit(0.01))
    return sized.withColumn("key", key).drop("unit", "weight")


def _slice(level: int) -> Column:
    """The slice of a row's key within the border slices of all earlier levels, 0 to ``SLICES`` - 1."""
    place = F.col("key") / (1 + F.col("key"))
    for k in range(level):
        # The part of the slice before, stretched to 0 to 1.
        place = place * SLICES - F.col(f"border{k}")
    return F.greatest(F.lit(0), F.least(F.lit(SLICES - 1), F.floor(place * SLICES))).cast("int")


def _borders(rows: DataFrame, weights: tuple[int, ...]) -> tuple[DataFrame, int]:
    """One row per source: its target, complete epochs, the rest, and the slice of keys where the rest is reached; and how many levels of slices.

    The slice that holds the border is sliced again until it has ``SORTED_ROWS`` rows at most.
    """
    now, level, plan = rows, 0, None
    while True:
        sums = now.withColumn("slice", _slice(level)).groupBy("same", "slice").agg(F.sum("size").alias("slice_size"), F.count("*").alias("n"))
        # The sizes of one source's slices: at most SLICES rows in a window.
        upto = Window.partitionBy("same").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        sums = settle(sums.withColumn("ahead", F.coalesce(F.sum("slice_size").over(upto), F.lit(0))))
        if plan is None:
            sizes = sums.groupBy("same").agg(F.sum("slice_size").alias("source_size"))
            plan = targets(sizes.select("same.source", "source_size"), weights).select(F.struct("source").alias("at"), "source_size", "target")
            epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0)
            rest = F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0))
            plan = plan.withColumn("epochs", epochs).withColumn("rest", rest).withColumn("before", F.lit(0).cast("bigint"))
        reached = sums.join(plan, F.col("same") == F.col("at")).filter("before + ahead <= rest").groupBy(*plan.columns)
        reached = reached.agg(F.max(F.struct("slice", "ahead", "n")).alias("b")).withColumn(f"border{level}", F.col("b.slice"))
        crowded = reached.agg(F.max("b.n")).first()[0] or 0
        plan = settle(reached.withColumn("before", F.col("before") + F.col("b.ahead")).drop("b"))
        level += 1
        if crowded <= SORTED_ROWS or level == MOST_LEVELS:
            return plan, level
        now = rows.join(if_small(plan), F.col("same") == F.col("at"))
        for k in range(level):
            now = now.filter(_slice(k) == F.col(f"border{k}"))
        now = now.select(*rows.columns, *(f"border{k}" for k in range(level)))


def _chosen(rows: DataFrame, border: DataFrame, levels: int) -> DataFrame:
    """``rows`` with ``source_size, target, epochs, chosen``; only the slices at the borders are sorted."""
    joined = rows.join(if_small(border), F.col("same") == F.col("at"))
    out = [*rows.columns, "source_size", "target", "epochs"]
    here, ahead = F.lit(True), F.lit(False)
    for k in range(levels):
        ahead = ahead | (here & (_slice(k) < F.col(f"border{k}")))
        here = here & (_slice(k) == F.col(f"border{k}"))
    joined = joined.withColumn("here", here).withColumn("ahead", ahead)
    upto = Window.partitionBy("same").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    at_border = joined.filter("here").withColumn("ends", F.col("before") + F.sum("size").over(upto))
    at_border = at_border.select(*out, (F.col("ends") - F.col("size") / 2 <= F.col("rest")).alias("chosen"))
    return joined.filter("not here").select(*out, F.col("ahead").alias("chosen")).unionByName(at_border)


def mix(docs: DataFrame, quality: DataFrame | None = None, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``doc_id, size, source_size, target, taken, source``, one row per row of ``docs`` (``doc_id, text, source``).

    ``taken`` is how many words the mix takes of the document, repeats counted.
    Every source first gives its complete epochs: ``floor(target / source_size)``
    copies of each document. The rest of its target comes from a weighted sample
    without replacement: every document gets the key ``-ln(u) / weight``, u from a
    hash of its id and text, and documents are taken in ascending order of keys
    up to the rest; the one at the border is taken if at least half of it fits.
    ``quality`` (``doc_id, weight``, one row per id) has quality weights; they
    count as 0.01 at least, and as 1 where there is none. The choice depends on
    nothing but the rows, so reruns agree.

    Null texts have size 0 and are never taken; a null source is a source of its
    own; null and repeated ids stay rows of their own, equal rows have equal keys
    and are interchangeable. An empty table gives an empty result.

    No source is sorted whole: keys are cut into ``SLICES`` slices, whose sizes are
    added up first, the slice at the border is cut again while it holds many rows,
    and only what is left of it is sorted row by row.
    """
    rows = settle(_keyed(docs, quality))
    taken = F.col("epochs") * F.col("size") + F.when(F.col("chosen"), F.col("size")).otherwise(0)
    return _chosen(rows, *_borders(rows, weights)).select(
        "doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken"), F.col("same.source").alias("source")
    )


def mixed(docs: DataFrame, quality: DataFrame | None = None, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as ``mix`` takes it.

    Documents without words are in no mix. Texts are read twice and, but for the
    slices at the borders, not shuffled.
    """
    border, levels = _borders(settle(_keyed(docs, quality)), weights)
    rows = _chosen(_keyed(docs, quality, F.struct("*")), border, levels)
    copies = (F.col("epochs") + F.when(F.col("chosen"), 1).otherwise(0)).cast("int")
    taken = rows.filter("size > 0").withColumn("copies", copies).filter("copies > 0")
    return taken.select("payload", F.explode(F.expr("sequence(1, copies)")).alias("copy")).select("payload.*")
