"""Alignment of two tokenizers' tokens by diagonal run skipping.

Both tokenizers give the ends of their tokens as ascending byte offsets in the
same text. As long as the tokens correspond one to one, the end arrays agree at a
constant index shift; such a stretch is measured by exponential probing (windows
twice as long each time, then halved where they first differ) and jumped. Where
the ends part, both sides advance until they meet again, which gives one irregular
group and the new shift.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import scratch, settle
from .pieces import ByteIds, Pieces, byte_letters, slices, with_space
from .sentencepieces import PieceModel, decimals

PAIR_BYTES = 24  # of a pair and its count where they are sent to the tasks


PROBE = 4  # ends compared first


def inner_ends(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Positions of the ends in ``a`` and in ``b`` that the other array does not have: those inside a group.

    Both ascend strictly and have the same last end.
    """
    a, b = a.tolist(), b.tolist()
    only_a, only_b, i, j, n = [], [], 0, 0, len(a)
    while i < n:
        size = PROBE
        while i < n and a[i : i + size] == b[j : j + size]:
            i, j, size = i + size, j + size, 2 * size
        if i >= n:
            break
        # The first difference lies in the window just probed.
        while (x := a[i]) == (y := b[j]):
            i, j = i + 1, j + 1
        while x != y:
            if x < y:
                only_a.append(i)
                i += 1
                x = a[i]
            else:
                only_b.append(j)
                j += 1
                y = b[j]
    return only_a, only_b


class Aligner:
    """Tokens of texts under a byte-level BPE file and a ``sentencepiece`` model, and the groups in which both end together."""

    def __init__(self, byte_file: str, piece_file: str):
        self.a, self.b = ByteIds(byte_file, specials_are_text=True), PieceModel(piece_file)
        entries, letters = self.a.library.get_vocab(with_added_tokens=True), {ch: b for b, ch in byte_letters().items()}
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for piece, i in entries.items():
            self.a_bytes[i] = bytes(letters[ch] for ch in piece) if all(ch in letters for ch in piece) else piece.encode()
        self.b_bytes = self.b.token_bytes()
        self.sizes = [np.array([len(x) for x in of], np.int64) for of in (self.a_bytes, self.b_bytes)]

        self.apart = self.a.apart & self.b.apart

    def _tokens(self, texts) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """Ids of both tokenizers and where each text begins in them; which texts may differ from their tokens' bytes."""
        spaced = with_space(texts)
        normal, records = self.b.normalised(texts)
        whole = np.ones(len(texts), bool) if self.b.joins else None
        shared = Pieces(spaced, self.apart, whole)
        own = shared if records is None else Pieces(normal, self.apart, whole)
        known = self.a.known(shared.distinct), self.b.known(own.distinct)
        out, odd = [], np.zeros(len(texts), bool)
        for cut, coded, of, dtype in zip((shared, own), known, (self.a_bytes, self.b_bytes), ("<u4", "<u8"), strict=True):
            bytes_of = lambda known: b"".join([of[i] for i in (np.frombuffer(known, dtype) & 0xFFFFFFFF).tolist()])  # noqa: B023, E731
            if bytes_of(b"".join(coded)) != b"".join(cut.distinct):
                odd |= cut.sums(np.array([bytes_of(x) != y for x, y in zip(coded, cut.distinct, strict=True)], np.int64)) > 0
            ids, starts = cut.gather(coded, dtype)
            out.append(((ids & 0xFFFFFFFF).astype("<u4"), starts))
        return out, odd | (records is not None)

    def _same(self, text: str, ids: np.ndarray, of: list[bytes]) -> bool:
        """Are the tokens' bytes, joined, the text behind a space?"""
        return b"".join([of[i] for i in ids.tolist()]) == b" " + text.encode()

    def groups(self, texts) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """For both tokenizers: ids, where each text begins in them, and which of them end a group.

        Texts that are empty, or whose bytes a tokenizer does not keep, have no tokens.
        """
        import pyarrow.compute as pc

        found, odd = self._tokens(texts)
        kept = pc.binary_length(texts).to_numpy() > 0
        for k in np.flatnonzero(kept & odd):
            text = texts[k].as_py()
            kept[k] = all(self._same(text, ids[at[k] : at[k + 1]], of) for (ids, at), of in zip(found, (self.a_bytes, self.b_bytes), strict=True))
        ids, starts, ends = [], [], []
        for (own, begins), sizes in zip(found, self.sizes, strict=True):
            counts = np.diff(begins)
            own = own[np.repeat(kept, counts)]
            ids.append(own)
            starts.append(np.concatenate([[0], np.cumsum(np.where(kept, counts, 0))]))
            ends.append(np.cumsum(sizes[own]))
        # Texts follow each other in one coordinate, so that stretches run on across them.
        inner = inner_ends(*ends)
        closes = []
        for own, at in zip(ids, inner, strict=True):
            closing = np.ones(len(own), bool)
            closing[at] = False
            closes.append(closing)
        return ids, starts, closes

    def linked(self, ids, starts, closes) -> tuple[np.ndarray, np.ndarray]:
        """``a << 32 | b`` of the tokens that end together, and where each text begins in them, then the end."""
        pairs = ids[0][closes[0]].astype(np.uint64) << np.uint64(32) | ids[1][closes[1]]
        return pairs, np.concatenate([[0], np.cumsum(closes[0])])[starts[0]]

    def listed(self, ids, starts, closes) -> list[bytes]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        before = [np.cumsum(c) - c for c in closes]  # groups closed before each token
        sizes = [np.diff(np.concatenate([[-1], np.flatnonzero(c)])) for c in closes]  # tokens of each group
        a_ahead, b_ahead = np.cumsum(sizes[0]), np.cumsum(sizes[1]) - sizes[1]
        places = np.arange(len(ids[0])) + b_ahead[before[0]], np.arange(len(ids[1])) + a_ahead[before[1]]
        both, marks = np.empty(len(ids[0]) + len(ids[1]), np.int64), np.full(len(ids[0]) + len(ids[1]), ord(","), np.uint8)
        for own, at, closing, mark in zip(ids, places, closes, "|;", strict=True):
            both[at] = own
            marks[at[closing]] = ord(mark)
        text, at = decimals(both, marks)
        text, at = text.tobytes(), at[starts[0] + starts[1]].tolist()
        return [text[x : max(x, y - 1)] for x, y in zip(at, at[1:], strict=False)]


def token_links(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """``row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times``, one row per row of ``docs``.

    ``pairs`` are the distinct id pairs (``a << 32 | b``) that the text links, in
    ascending order, and ``times`` how often. The table is written to the shared
    folder, so that texts are tokenized once.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def align(batches):
        import pyarrow as pa

        aligner = Aligner(byte_file, piece_file)
        for batch in batches:
            for first, texts in slices(batch):
                ids, starts, closes = aligner.groups(texts)
                digests = [hashlib.sha256(x).hexdigest() if x else "" for x in aligner.listed(ids, starts, closes)]
                links, at = aligner.linked(ids, starts, closes)
                # Distinct pairs of each text: texts stay in order, pairs are sorted within them.
                order = np.lexsort((links, np.repeat(np.arange(len(texts)), np.diff(at))))
                links = links[order]
                new = np.ones(len(links), bool)
                new[1:] = links[1:] != links[:-1]
                new[at[:-1][np.diff(at) > 0]] = True
                where = np.flatnonzero(new)
                times = np.diff(np.append(where, len(links)))
                cuts = np.searchsorted(where, at)
                lists = [pa.LargeListArray.from_arrays(cuts, pa.array(x.astype(np.int64))).cast(pa.list_(pa.int64())) for x in (links[where].view(np.int64), times)]
                counts = [pa.array(np.diff(x)) for x in (*starts, at, at)]
                own = batch.column("doc_id").slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([own, *counts, pa.array(digests, pa.string()), *lists], names=["doc_id", *_NUMBERS, "groups_sha256", "pairs", "times"])

    kinds = ", ".join(f"{c} bigint" for c in _NUMBERS)
    made = docs.select("doc_id", "text").mapInArrow(align, f"doc_id {id_type}, {kinds}, groups_sha256 string, pairs array<bigint>, times array<bigint>")
    spark, place = docs.sparkSession, scratch(docs.sparkSession, "links")
    made.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(place)
    return spark.read.parquet(place)


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair, n, best`` from ``token_links``: how many links hold each id pair, and whether no pair with its b has more.

    Pairs are added up per batch before anything is shuffled.
    """

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            pairs, times = (batch.column(c).flatten().to_numpy() for c in ("pairs", "times"))
            own, number = np.unique(pairs, return_inverse=True)
            n = np.zeros(len(own), np.int64)
            np.add.at(n, number, times)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n)], names=["pair", "n"])

    counted = settle(links.select("pairs", "times").mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")))
    of_b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counted.groupBy(of_b.alias("b")).agg(F.max("n").alias("most"))
    # One row per entry of the second vocabulary, hence the broadcast.
    return settle(counted.join(F.broadcast(most), of_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def aligned(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, one row per row of ``docs``.

    A are the tokens of each text, behind a space, under the byte-level BPE file,
    B those under the ``sentencepiece`` model. Where tokens of both end at the same
    byte a group ends, and these two tokens are linked. ``n_best`` counts links
    whose pair is the most frequent one of its B id in the whole table, ties
    included; ``count_sum`` adds up the pairs' frequencies. Null and empty texts,
    and texts whose bytes a tokenizer does not keep, have no tokens: zeros and an
    empty digest. Null and repeated ids stay rows of their own, further columns
    are not read; an empty table gives an empty result.

    The table of pairs is sent to the tasks as long as it holds no more than
    ``common.BROADCAST_BYTES``; beyond that each document's pairs are joined to it.
    """
    links = token_links(docs, byte_file, piece_file)
    pairs = pair_counts(links)
    if pairs.count() * PAIR_BYTES <= common.BROADCAST_BYTES:
        return _looked_up(links, pairs)
    each = links.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    sums = (
        each.join(pairs, "pair")
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    )
    joined = links.drop("pairs", "times").join(sums, "row", "left")
    return joined.select("doc_id", *_NUMBERS, *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_best", "count_sum")), "groups_sha256")


def _looked_up(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """The sums of each row, from a table of pairs that every task holds."""
    rows = pairs.toArrow()
    names = rows.column("pair").to_numpy()
    order = np.argsort(names)
    sent = links.sparkSession.sparkContext.broadcast((names[order], rows.column("n").to_numpy()[order], rows.column("best").to_numpy()[order]))

    def add_up(batches):
        import pyarrow as pa

        names, n, best = sent.value
        for batch in batches:
            own, times = (batch.column(c).flatten().to_numpy() for c in ("pairs", "times"))
            at = np.concatenate([[0], np.cumsum(batch.column("pairs").value_lengths().to_numpy())])
            place = np.searchsorted(names, own)
            sums = [np.diff(np.concatenate([[0], np.cumsum(x[place] * times)])[at]) for x in (best, n)]
            kept = [batch.column(c) for c in ("doc_id", *_NUMBERS, "groups_sha256")]
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, sums)], names=["doc_id", *_NUMBERS, "groups_sha256", "n_best", "count_sum"])

    kinds = ", ".join(f"{c} bigint" for c in _NUMBERS)
    schema = f"doc_id {links.schema['doc_id'].dataType.simpleString()}, {kinds}, groups_sha256 string, n_best bigint, count_sum bigint"
    return links.drop("row").mapInArrow(add_up, schema).select("doc_id", *_NUMBERS, "n_best", "count_sum", "groups_sha256")
