"""MinHash near-duplicates with tensored banding.

A plain banding index computes ``tables * rows`` minhashes. Here ``HALVES`` small
collections of ``k`` minhashes are computed, and the keys of the tables are the
pairs of them: 32 collections give 496 tables from 32 * k minhashes. Two sets
share a table if at least two collections agree, so a pair of similarity s is
missed with the chance that at most one of 32 agrees, each with s**k; ``k`` is
the largest for which that is below ``MISS`` at the threshold.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import if_small, narrow, settle, small_batches, without_rows
from .linking import linked

HALVES = 32
MISS = 2e-5
KNOWN_WORDS = 1 << 16
SET_ROWS = 1 << 13  # sets with their minhashes in a partition

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def minhashes_per_half(threshold: float) -> int:
    """The most minhashes in a collection that keep the miss rate at ``threshold`` below ``MISS``."""
    k = 1
    while True:
        p = threshold ** (k + 1)
        if (1 - p) ** HALVES + HALVES * p * (1 - p) ** (HALVES - 1) > MISS:
            return k
        k += 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _MIX
    x = x ^ (x >> np.uint64(32))
    x = x * _MIX
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sets of word shingles as sorted 64-bit hashes.

    Words are runs other than space, tab, line feed, vertical tab, form feed and
    carriage return, A-Z in lower case. A text of fewer words than a shingle
    is one shingle; without words the set is empty.
    """

    def __init__(self, words: int):
        import xxhash

        self.words, self.hash, self.known = words, xxhash.xxh64_intdigest, {}

    def __call__(self, text: str | None) -> np.ndarray:
        known, own = self.known, (text or "").encode().lower().split()
        if not own:
            return np.zeros(0, np.uint64)
        try:
            codes = np.array(list(map(known.__getitem__, own)), np.uint64)
        except KeyError:
            if len(known) > KNOWN_WORDS:
                known.clear()
            for w in own:
                if w not in known:
                    known[w] = self.hash(w)
            codes = np.array(list(map(known.__getitem__, own)), np.uint64)
        width = min(self.words, len(codes))
        total = np.full(len(codes) - width + 1, width, np.uint64)
        for i in range(width):
            total = (total ^ codes[i : len(codes) - width + 1 + i]) * _ODD
            total ^= total >> np.uint64(29)
        return np.unique(_mixed(total))


def halves_of(hashes: np.ndarray, k: int) -> np.ndarray:
    """``HALVES`` keys, each made of ``k`` minhashes of the set."""
    rng = np.random.default_rng(20240607)
    flip = rng.integers(0, 2**63, HALVES * k, dtype=np.uint64)[:, None]
    times = rng.integers(0, 2**63, HALVES * k, dtype=np.uint64)[:, None] | np.uint64(1)
    least = np.full(HALVES * k, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(hashes), 1024):
        np.minimum(least, ((hashes[a : a + 1024] ^ flip) * times).min(axis=1), out=least)
    key = np.arange(1, HALVES + 1, dtype=np.uint64) * _ODD
    for part in least.reshape(HALVES, k).T:
        key = _mixed(key ^ part)
    return key


def _set_key(hashes: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).astype(np.int64))


def overlapping(percent: int):
    """Compares lists of packed hash sets: is ``100 * shared >= percent * union``?"""

    def similar(left: list[bytes], right: list[bytes]) -> np.ndarray:
        sets = [np.frombuffer(x, np.uint64) for x in [*left, *right]]
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        sizes = np.array([len(s) for s in sets])
        _, code, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        keep = seen[code] > 1  # a hash of one set alone is in no intersection
        owner, code = owner[keep], code[keep]
        names, code = np.unique(code, return_inverse=True)
        shared = np.zeros((len(left), len(right)))
        order = np.argsort(code, kind="stable")
        owner, code = owner[order], code[order]
        for a in range(0, len(names), 4096):
            lo, hi = np.searchsorted(code, [a, a + 4096])
            part = np.zeros((len(sets), min(4096, len(names) - a)), np.float32)
            part[owner[lo:hi], code[lo:hi] - a] = 1
            shared += part[: len(left)] @ part[len(left) :].T
        union = sizes[: len(left), None] + sizes[None, len(left) :] - shared
        return 100 * shared >= percent * union

    return similar


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_hash``: groups of documents linked by ``100 * shared >= percent * union``.

    One row per row of ``docs`` (``doc_id, text``; further columns are not read).
    Candidates are found by tensored banding, links are confirmed on the full sets
    of shingles, and ``component_id`` is the smallest ``doc_id`` that a document
    reaches over links. Documents of equal sets are one node from the start, so
    copies never meet in pairs. Empty and null texts have no shingle and no link:
    their own id is their component. Null ids are ignored when the smallest is
    taken; ``component_id`` is null where a group has no other, and ``kept``
    compares null-safely, so such documents are kept. Rows that repeat a
    ``doc_id`` count as one document. Sets are known by 64-bit hashes.
    """
    small_batches(docs.sparkSession)
    k = minhashes_per_half(percent / 100)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches):
        import pyarrow as pa

        shingles = Shingler(words)
        for batch in batches:
            n, keys, halves = [], [], []
            for text in batch.column("text").to_pylist():
                own = shingles(text)
                n.append(len(own))
                keys.append(_set_key(own) if len(own) else None)
                halves.append(halves_of(own, k).astype(np.int64) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64()), pa.array(keys, pa.int64()), pa.array(halves, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "set_key", "halves"],
            )

    docs_hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    signed = narrow(docs_hashed.mapInArrow(sign, f"doc_id {id_type}, text_hash bigint, n_shingles bigint, set_key bigint, halves array<bigint>"), SET_ROWS)

    # Equal sets are one node; their copies combine before the shuffle.
    sets = narrow(signed.filter("set_key is not null").groupBy("set_key").agg(F.first("halves").alias("halves")), SET_ROWS)
    rows = sets.select("set_key", F.explode("halves").alias("half"))
    # Keys of one half that only one set has cannot meet anything. Tables of
    # their own leave the joins free to split a half that very many sets have.
    shared = narrow(rows.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1"))
    mine = rows.join(shared, "half")
    nodes = narrow(mine.groupBy("set_key").agg(F.array_sort(F.collect_set("half")).alias("halves"), F.sum("n").alias("weight")).filter("size(halves) > 1"), SET_ROWS)
    pairs = F.expr("flatten(transform(halves, (x, i) -> transform(slice(halves, i + 2, size(halves)), y -> xxhash64(x, y))))")
    buckets = nodes.select(F.explode(pairs).alias("key"), F.col("set_key").alias("id"))

    def sets_of(ids: DataFrame) -> DataFrame:
        """The shingles of one document for each set."""
        # Copies of a set combine before anything meets by set.
        one = (
            signed.filter("set_key is not null")
            .groupBy("set_key")
            .agg(F.min(F.struct("doc_id", "text_hash")).alias("of"))
            .join(ids.select(F.col("id").alias("set_key")), "set_key")
            .select("set_key", F.col("of.doc_id").alias("of_id"), F.col("of.text_hash").alias("of_hash"))
        )
        texts = docs_hashed.join(if_small(settle(one)), F.col("doc_id").eqNullSafe(F.col("of_id")) & F.col("text_hash").eqNullSafe(F.col("of_hash")))

        def pack(batches):
            import pyarrow as pa

            shingles = Shingler(words)
            for batch in batches:
                packed = [shingles(t).tobytes() for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("set_key"), pa.array(packed, pa.binary())], names=["id", "item"])

        return texts.select("set_key", "text").mapInArrow(pack, "id bigint, item binary").dropDuplicates(["id"])

    root = linked(buckets, nodes.select(F.col("set_key").alias("id"), "weight"), sets_of, overlapping(percent))
    root = narrow(root)
    # Only sets of several rows or with links need a label; the others are their own.
    grouped = signed.filter("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("least"))
    labelled = grouped.join(root.withColumnRenamed("id", "set_key"), "set_key", "left").withColumn("root", F.coalesce("root", "set_key"))
    label = narrow(labelled.groupBy("root").agg(F.min("least").alias("component_id")))
    labels = labelled.join(label, "root").select("set_key", "component_id")
    return (
        signed.select("doc_id", "n_shingles", "set_key", "text_hash")
        .join(labels, "set_key", "left")
        .withColumn("component_id", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash")
    )


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns.

    Rows are known by id and text, so rows that repeat both stay or go together.
    """
    gone = near_duplicates(docs, words, percent).filter("not kept").select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"))
    return without_rows(docs, gone)
