"""Links between similar items, and the groups that they connect.

Candidates come as buckets ``(key, id)``. Links are found in two steps:

1. In every bucket all members are compared with one leader, the member with the
   greatest weight. That is linear in the bucket, and settles buckets whose
   members all belong together.
2. Components that share a bucket without a link form candidate groups. The
   members of such a group are dealt into blocks, and every pair of blocks with
   different components is compared inside one task. A component of more than a
   block's size has blocks of its own, and a pair of blocks of the same component
   is left out, so the work is that of the members that remain unlinked. A task
   returns a spanning forest of its links, never all pairs.

So no link between two members of one candidate group is missed, and no step
writes a row per pair.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, narrow, settle

BLOCK = 256  # members compared at once
BLOCK_BYTES = 8_000_000  # of the items of a block, about; a larger item is a block of its own
LOT_BYTES = 16_000_000  # of the items of small groups that a task gets together
LOT_ROWS = 1000  # of them, and no more rows than this
EDGES = 1 << 17  # in a partition


def connected(edges: DataFrame) -> DataFrame:
    """``id, root`` for every id of ``edges`` (``a, b``): the smallest id that it reaches.

    Rounds of star contraction: neighbours of a node are tied to the smallest of
    them, first the larger neighbours, then the smaller ones, until nothing
    changes; the number of rounds grows with the logarithm of the longest path.
    Minima combine before the shuffle; nothing gathers the neighbours of a node.
    Null ends and loops count as no edge.
    """
    now = settle(
        edges.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
        # Partitions in proportion to the edges; the smallest neighbours of few nodes are broadcast.
        parts = 2 * (1 + seen[0] // EDGES)
        few = F.broadcast if 64 * seen[0] <= BROADCAST_BYTES else lambda df: df
        now = now.coalesce(parts)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts)
        large = both.filter("v > u").join(few(low), "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts)
        small = large.join(few(low), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = settle(small.unionByName(low.withColumnRenamed("m", "v")).distinct().coalesce(parts))
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)


class Groups:
    """Groups that links join, in one task."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        """Were they apart?"""
        a, b = self.top(a), self.top(b)
        self.up[a] = b
        return a != b


def _forest(left: list[int], right: list[int]) -> list[int]:
    """Positions of the links that join two parts not joined before."""
    groups = Groups()
    return [i for i, (a, b) in enumerate(zip(left, right, strict=True)) if groups.join(a, b)]


def linked(buckets: DataFrame, weights: DataFrame | None, items: Callable[[DataFrame], DataFrame], similar: Callable, leaders_only: bool = False) -> DataFrame:
    """``id, root``: the components of the members of ``buckets`` (``key, id``) under links between similar ones.

    Members that share no bucket with another may be left out. ``root`` is the
    smallest id of the component.

    ``weights`` (``id, weight``) chooses the leaders, or all weigh the same.
    ``items`` gives ``id, item`` for the ids of a table; ``similar`` takes two
    lists of items and returns a boolean matrix, one row per left item. Both run
    on data of bounded size: a leader and at most ``BLOCK`` members, or two blocks.

    ``leaders_only`` ends after step 1, for buckets that bring together many members
    that are not similar: the groups are then parts of the components.
    """
    weighed = buckets.join(weights, "id") if weights is not None else buckets.withColumn("weight", F.lit(0))
    # A table of its own, so that the join can split a bucket with very many members.
    leaders = weighed.groupBy("key").agg(F.max(F.struct("weight", "id"))["id"].alias("leader"), F.count("*").alias("n"))
    leaders = narrow(leaders.filter("n > 1").select("key", "leader"))
    stars = narrow(
        buckets.join(leaders, "key").filter("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    )
    ids = stars.select(F.col("a").alias("id")).unionByName(stars.select(F.col("b").alias("id"))).distinct()
    held = settle(items(ids))
    bytes_of = narrow(held.select("id", F.octet_length("item").alias("bytes")))
    n_held, n_bytes = bytes_of.agg(F.count("*"), F.sum("bytes")).first()
    held = held.coalesce(1 + max(n_held // EDGES, (n_bytes or 0) // LOT_BYTES))
    blocks_of = lambda n: F.ceil(F.greatest(n / BLOCK, F.sum("bytes") / BLOCK_BYTES))

    # 1: members against their leader, at most BLOCK of them in a group.
    size = stars.join(bytes_of.withColumnRenamed("id", "b"), "b").groupBy("a").agg(blocks_of(F.count("*")).alias("n"))
    size = narrow(size)
    dealt = stars.join(size, "a").select("a", F.pmod(F.xxhash64("b"), "n").alias("part"), F.col("b").alias("id"))
    heads = dealt.select("a", "part").distinct().withColumn("id", F.col("a"))
    facing = dealt.unionByName(heads).select(
        F.xxhash64("a", "part").alias("group"), (F.col("id") == F.col("a")).cast("int").alias("side"), F.col("a").alias("comp"), "id"
    )
    first = narrow(_compared(facing, held, bytes_of, similar, False))

    # 2: components that face each other across a star without a link of their own.
    comp = settle(connected(first))
    side = lambda end: comp.select(F.col("id").alias(end), F.col("root").alias(f"comp_{end}"))
    of_comp = narrow(held.select("id").join(comp, "id", "left").select("id", F.coalesce("root", "id").alias("comp")))
    if leaders_only:
        return of_comp.withColumnRenamed("comp", "root")
    placed = _facing(stars, side, of_comp)
    sized = placed.join(bytes_of, "id")
    sizes = narrow(sized.groupBy("group", "comp").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"), blocks_of(F.count("*")).alias("parts")))
    # Components of less than a block share blocks, the others have blocks of their own.
    loose = sizes.filter("parts <= 1").groupBy("group").agg(blocks_of(F.sum("n")).alias("loose"))
    open_ = narrow(
        placed.join(sizes.drop("bytes"), ["group", "comp"])
        .join(loose, "group", "left")
        .select(
            "group",
            "comp",
            "id",
            F.when(F.col("parts") > 1, F.col("comp")).alias("own"),
            F.when(F.col("parts") > 1, F.pmod(F.xxhash64("id"), F.col("parts"))).otherwise(F.pmod(F.xxhash64("comp"), F.col("loose"))).alias("slot"),
        )
    )
    blocks = narrow(open_.select("group", "own", "slot").distinct())
    mine, other = blocks.alias("x"), blocks.alias("y")
    ordered = F.struct(F.col("x.own"), F.col("x.slot")) <= F.struct(F.col("y.own"), F.col("y.slot"))
    pairs = (
        mine.join(other, F.col("x.group") == F.col("y.group"))
        .filter(ordered & (F.col("x.own").isNull() | ~F.col("x.own").eqNullSafe(F.col("y.own"))))
        .select(
            F.xxhash64("x.group", "x.own", "x.slot", "y.own", "y.slot").alias("pair"),
            F.explode(
                F.array(
                    F.struct(F.lit(1).alias("side"), F.col("x.group"), F.col("x.own"), F.col("x.slot")),
                    F.struct(F.lit(0).alias("side"), F.col("y.group"), F.col("y.own"), F.col("y.slot")),
                )
            ).alias("at"),
        )
        .select("pair", "at.*")
    )
    s, o = pairs.alias("s"), open_.alias("o")
    members = s.join(
        o, (F.col("s.group") == F.col("o.group")) & (F.col("s.slot") == F.col("o.slot")) & F.col("s.own").eqNullSafe(F.col("o.own"))
    ).select(F.col("pair").alias("group"), "side", "comp", "id")
    second = narrow(_compared(members, held, bytes_of, similar, True))
    comp_of = lambda end: of_comp.select(F.col("id").alias(end), F.col("comp").alias(f"comp_{end}"))
    joined = second.join(comp_of("a"), "a").join(comp_of("b"), "b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))
    last = connected(joined).select(F.col("id").alias("comp"), "root")
    return of_comp.join(last, "comp", "left").select("id", F.coalesce("root", "comp").alias("root"))


def _facing(stars: DataFrame, side: Callable, of_comp: DataFrame) -> DataFrame:
    """``comp, id, group``: the members of components that stars without a link connect."""
    across = stars.join(side("a"), "a", "left").join(side("b"), "b", "left").select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b"))
    facing = connected(across.filter("a <> b")).select(F.col("id").alias("comp"), F.col("root").alias("group"))
    return narrow(of_comp.join(facing, "comp"))


def _compared(members: DataFrame, held: DataFrame, bytes_of: DataFrame, similar: Callable, forest: bool) -> DataFrame:
    """Links between the sides of each group of ``members`` (``group, side, comp, id``)."""

    def pair_up(side, comp, ids, items):
        left, right = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
        if not len(left) or not len(right):
            return [], []
        found = similar([items[i] for i in left], [items[i] for i in right])
        found = found & (ids[left][:, None] != ids[right][None, :])
        if forest:
            found &= comp[left][:, None] != comp[right][None, :]
        i, j = found.nonzero()
        a, b = left[i], right[j]
        if forest:
            kept = _forest(comp[a].tolist(), comp[b].tolist())
            a, b = a[kept], b[kept]
        return ids[a], ids[b]

    def compare(pdf):
        pdf = pdf.sort_values("group", kind="stable")
        group, side, comp, ids = (pdf[c].to_numpy() for c in ("group", "side", "comp", "id"))
        items = pdf["item"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        found = [pair_up(side[x:y], comp[x:y], ids[x:y], items[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]
        a, b = (np.concatenate([np.asarray(f[k], np.int64) for f in found]) for k in (0, 1))
        return pd.DataFrame({"a": a, "b": b})

    # Small groups are handed over together, as many as have about LOT_ROWS rows or LOT_BYTES of items.
    members = narrow(members)
    rows, size = members.join(bytes_of, "id").agg(F.count("*"), F.sum("bytes")).first()
    lots = int(max(1, rows // LOT_ROWS, (size or 0) // LOT_BYTES))
    given = members.join(held, "id").withColumn("lot", F.pmod(F.xxhash64("group"), F.lit(lots)))
    return given.select("lot", "group", "side", "comp", "id", "item").groupBy("lot").applyInPandas(compare, "a bigint, b bigint")
