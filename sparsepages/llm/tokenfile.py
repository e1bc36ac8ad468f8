"""Token-ID output in directly addressable codes.

A file holds the ids of consecutive documents. Every id is split into chunks of
8 bits, lowest first. Level 0 has the first chunk of all ids; a bitmap says which
ids go on, and level 1 has the second chunk of those only, and so on. A rank
directory holds the number of set bits before every 512th bit, so the chunks of
any id are found by at most one short count per level and no other id is decoded.

Layout, little-endian::

    magic "DACT0001", u64 documents, u64 ids, u64 levels,
    u64 starts[documents + 1]                    first id of each document, then the total
    per level: u64 chunks, u8 chunks[...],
               u8 bitmap[ceil(chunks / 8)],       lowest bit first
               u64 ranks[ceil(chunks / 512)]
    i64 doc_ids[documents], u8 is_null[documents]
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import whole_ids
from .pieces import ByteIds, slices

MAGIC = b"DACT0001"
BLOCK = 512
FILE_IDS = 1 << 22  # ids after which a file is closed
END_ID = 0
MOST_TASKS = 10_000  # that read files back


# ---- the format ---------------------------------------------------------------


def pack(ids: np.ndarray, starts: np.ndarray, doc_ids: list) -> bytes:
    """The file of ``ids`` (unsigned 32-bit) of documents that begin at ``starts``."""
    levels, rest = [], ids
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        counts = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.uint64) if len(more) else np.zeros(0, np.uint64)
        ranks = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("<u8") if len(counts) else counts.astype("<u8")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes())
        rest = rest[more] >> 8
        if not len(rest):
            break
    null = np.array([d is None for d in doc_ids], np.uint8)
    names = np.array([0 if d is None else d for d in doc_ids], "<i8")
    head = MAGIC + struct.pack("<QQQ", len(doc_ids), len(ids), len(levels))
    total = np.concatenate([starts, [len(ids)]]).astype("<u8")
    return b"".join([head, total.tobytes(), *levels, names.tobytes(), null.tobytes()])


class TokenFile:
    """Random access to the ids in the bytes of one file (any buffer, also a memory map)."""

    def __init__(self, data):
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a token file")
        self.n_docs, self.n_ids, n_levels = struct.unpack_from("<QQQ", data, 8)
        at = 32
        self.starts = np.frombuffer(data, "<u8", self.n_docs + 1, at)
        at += 8 * (self.n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            bitmap = np.frombuffer(data, np.uint8, -(-n // 8), at + 8 + n)
            ranks = np.frombuffer(data, "<u8", -(-n // BLOCK), at + 8 + n + len(bitmap))
            self.levels.append((chunks, bitmap, ranks))
            at += 8 + n + len(bitmap) + 8 * len(ranks)
        names = np.frombuffer(data, "<i8", self.n_docs, at)
        null = np.frombuffer(data, np.uint8, self.n_docs, at + 8 * self.n_docs)
        self.doc_ids = [None if z else int(d) for d, z in zip(names, null, strict=True)]

    @staticmethod
    def _rank(bitmap: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Set bits before bit ``i``."""
        block = i // BLOCK
        first, last = block * BLOCK // 8, i // 8
        inside = int(np.bitwise_count(bitmap[first:last]).sum())
        if i % 8:
            inside += int(bitmap[last] & ((1 << (i % 8)) - 1)).bit_count()
        return (int(ranks[block]) if block < len(ranks) else int(ranks[-1])) + inside

    def __getitem__(self, i: int) -> int:
        """The ``i``-th id, without decoding any other."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = shift = 0
        for chunks, bitmap, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bitmap[i // 8] >> (i % 8) & 1:
                break
            i, shift = self._rank(bitmap, ranks, i), shift + 8
        return value

    def span(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last`` (exclusive)."""
        if last <= first:
            return np.zeros(0, "<u4")
        out = np.zeros(last - first, "<u4")
        where, shift, a, b = None, 0, first, last
        for chunks, bitmap, ranks in self.levels:
            part = chunks[a:b].astype("<u4") << shift
            if where is None:
                out |= part
            else:
                out[where] |= part
            low = a // 8
            more = np.unpackbits(bitmap[low : -(-b // 8)], bitorder="little")[a - 8 * low : b - 8 * low].astype(bool)
            if not more.any():
                break
            a = self._rank(bitmap, ranks, a)
            b, shift = a + int(more.sum()), shift + 8
            where = np.flatnonzero(more) if where is None else where[more]
        return out

    def document(self, k: int) -> np.ndarray:
        """The ids of the ``k``-th document."""
        return self.span(int(self.starts[k]), int(self.starts[k + 1]))


# ---- files --------------------------------------------------------------------


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}" if not uri.startswith("file:") else uri.replace("file:", "file://", 1))


def write_tokens(docs: DataFrame, vocabulary: str, path: str, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Encodes every whole text and writes the files to ``path``; returns their list ``part, piece, file, n_docs, n_ids``.

    ``docs`` has ``doc_id`` and ``text``; further columns are not read. Documents
    lie in ascending ``doc_id`` order over the files in the order of their names,
    null ids first; rows of one id are ordered by a hash of the text, so a repeated
    row changes nothing but its own number. A null or empty text is the end id
    alone. An empty table gives an empty list and no files. Ids that are no whole
    numbers are refused.

    Rows are dealt by ranges of ``doc_id`` (and of the text's hash within one id),
    sorted, and encoded as they are written: a task holds one file's ids at a
    time. Files get their final names by a rename after they are complete, and a
    task that is run again writes the same bytes under the same names.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("_tie")]
    dealt = (
        docs.select(whole_ids(docs).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_tie")
    )

    def write(batches):
        import pyarrow as pa

        encoder = ByteIds(vocabulary)
        part, made = TaskContext.get().partitionId(), []
        fs, folder = _open(path)
        fs.create_dir(folder, recursive=True)
        names, ids, sizes, held = [], [], [], 0  # of the documents of the file at hand

        def close():
            nonlocal names, ids, sizes, held
            starts = np.cumsum(np.concatenate(sizes))
            starts = np.concatenate([[0], starts[:-1]])
            name = f"{folder}/part-{part:06d}-{len(made):06d}.dact"
            own = f"{folder}/_{part:06d}-{len(made):06d}-{TaskContext.get().taskAttemptId()}"
            with fs.open_output_stream(own) as out:
                out.write(pack(np.concatenate(ids), starts, names))
            fs.move(own, name)
            made.append((part, len(made), name.rpartition("/")[2], len(names), held))
            names, ids, sizes, held = [], [], [], 0

        for batch in batches:
            for first, texts in slices(batch):
                own, starts = encoder.ids(texts)
                own = np.insert(own, starts[1:], np.uint32(end_id))
                starts = starts + np.arange(len(starts))
                doc_ids, at = batch.column("doc_id").slice(first, len(texts)).to_pylist(), 0
                while at < len(texts):
                    # Documents up to the one with which the file is full.
                    to = min(len(texts), int(np.searchsorted(starts, starts[at] + file_ids - held)))
                    to = max(to, at + 1)
                    names += doc_ids[at:to]
                    ids.append(own[starts[at] : starts[to]])
                    sizes.append(np.diff(starts[at : to + 1]))
                    held += int(starts[to] - starts[at])
                    at = to
                    if held >= file_ids:
                        close()
        if names:
            close()
        columns = list(zip(*made, strict=True)) or [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "piece", "file", "n_docs", "n_ids"])

    dealt.mapInArrow(write, "part int, piece int, file string, n_docs bigint, n_ids bigint").write.parquet(f"{path}/_list")
    return token_files(docs.sparkSession, path)


def token_files(spark: SparkSession, path: str) -> DataFrame:
    """The list of the files that ``write_tokens`` has left in ``path``."""
    return spark.read.schema("part int, piece int, file string, n_docs bigint, n_ids bigint").parquet(f"{path}/_list")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the files in ``path``.

    ``start`` counts the ids of all documents before it, in file order;
    ``ids_crc32`` is the unsigned crc32 of its ids as little-endian unsigned
    32-bit integers. The offsets of the files are one window over one row per
    file; the ids are read in parallel, file by file.
    """
    before = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    files = token_files(spark, path).withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def read(batches):
        import pyarrow as pa

        fs, folder = _open(path)
        for batch in batches:
            for name, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist(), strict=True):
                with fs.open_input_file(f"{folder}/{name}") as source:
                    file = TokenFile(source.read_buffer())
                starts = file.starts.astype(np.int64)
                crcs = [zlib.crc32(file.document(k).tobytes()) for k in range(file.n_docs)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.doc_ids, pa.int64()), pa.array(first + starts[:-1]), pa.array(np.diff(starts)), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    tasks = min(MOST_TASKS, max(1, files.count()))
    return files.select("file", "first").repartition(tasks, "file").mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
