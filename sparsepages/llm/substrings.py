"""Repeated passages by content-defined chunking with a gear rolling hash.

A chunk ends after a word whose hash is the greatest among the three words before
and after it. The hash is a gear hash of the 32 bytes up to the word's end, so
the ends depend on their close surroundings alone: an insertion moves the chunks
next to it, and behind it the same chunks follow as before. Chunks hold four words
at least and about seven. Where a short phrase is repeated the greatest hashes are
equal; a chunk then ends after some of them, six words apart. Text that goes on
without white space is also cut between characters, where the hash is the greatest
among 16 characters on either side, from the 64th byte of such a run on. Equal chunks have equal digests; a run of chunks that
stand further ahead too, in this or another document, is a repeated passage.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

REACH = 3  # words on either side that a chunk's last word must outdo
LEAST_WORDS = 20  # words of a repeated passage
WORD_CHARS = 8  # a passage of fewer words counts if it has that many characters for each word it should have
LONG_RUN = 64  # bytes without white space after which characters are cut points
RUN_REACH = 16  # characters on either side that a cut point must outdo

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def _gear() -> np.ndarray:
    return np.random.default_rng(6).integers(0, 2**32, 256, dtype=np.uint32)


def _peaks(value: np.ndarray, reach: int) -> np.ndarray:
    """Where ``value`` is the greatest among ``reach`` neighbours on either side.

    Of equal ones within reach of each other the first, and further ones that are
    a whole number of distances, and twice ``reach`` or more, apart.
    """
    n = len(value)
    padded = np.concatenate([np.full(reach, -1), value, np.full(reach, -1)])
    best, tied = np.ones(n, bool), np.zeros(n, bool)
    for k in range(1, reach + 1):
        before = padded[reach - k : reach - k + n]
        best &= (value >= before) & (value >= padded[reach + k : reach + k + n])
        tied |= value == before
    at = np.flatnonzero(best)
    best &= ~tied
    if len(at) > 1:
        apart = np.diff(at, prepend=at[0])
        goes_on = (apart > 0) & (apart <= reach) & (value[at] == value[np.roll(at, 1)])
        start = at[np.maximum.accumulate(np.where(goes_on, 0, np.arange(len(at))))]
        apart = np.maximum(apart, 1)
        best[at[goes_on & ((at - start) % (apart * -(-2 * reach // apart)) == 0)]] = True
    return best


def _run_cuts(data: np.ndarray, rolled: np.ndarray, starts: np.ndarray, white: np.ndarray) -> np.ndarray:
    """Cut points between characters in long runs without white space, which begin at ``starts``."""
    ends = np.flatnonzero(~white & np.append(white[1:], True)) + 1
    long_ = ends - starts > LONG_RUN
    inside, values, run = [], [], []
    for number, (a, b) in enumerate(zip(starts[long_].tolist(), ends[long_].tolist(), strict=True)):
        at = np.flatnonzero((data[a + LONG_RUN : b] & 0xC0) != 0x80) + a + LONG_RUN
        inside.append(at)
        run.append(np.full(len(at), number))
    if not inside:
        return np.zeros(0, np.int64)
    at = np.concatenate(inside)
    place = np.arange(len(at)) + RUN_REACH * np.concatenate(run)  # runs do not reach into each other
    values = np.full(len(at) + RUN_REACH * len(inside), -1, np.int64)
    values[place] = (rolled[at - 1] * np.uint32(2654435761)).astype(np.int64)
    return at[_peaks(values, RUN_REACH)[place]]


def chunk_ends(data: np.ndarray, gear: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions after each chunk's last word and white space, or in a long run, and the number of words begun up to there."""
    white = _WHITE[data]
    starts_after = np.flatnonzero(white[:-1] & ~white[1:]) + 1  # a word begins here, white space before it
    n = len(starts_after)
    rolled = gear[data]
    for width in (1, 2, 4, 8, 16):
        rolled[width:] = rolled[width:] + (rolled[:-width] << np.uint32(width))
    # White space before the next word does not count: the hash is taken at the word's last byte.
    at = starts_after - 1
    while n and white[at].any():
        at = np.where(white[at] & (at > 0), at - 1, at)
        if not (white[at] & (at > 0)).any():
            break
    value = (rolled[at] * np.uint32(2654435761)).astype(np.int64)
    lead = 1 if len(data) and not white[0] else 0
    lead = 1 if len(data) and not white[0] else 0
    if n or lead:
        starts = np.concatenate([np.zeros(lead, np.int64), starts_after])
        ends = np.concatenate([starts_after[_peaks(value, REACH)], _run_cuts(data, rolled, starts, white)])
        ends = np.append(np.sort(ends), len(data))
        return ends, np.searchsorted(starts, ends)
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def chunks(docs: DataFrame) -> DataFrame:
    """``doc_id, doc, chunk, digest, n_words, first, last``: the chunks of every whole text, in order.

    ``first`` and ``last`` are code-point positions, ``last`` exclusive; all
    chunks of a text together are the text. ``doc`` orders the documents: the id,
    or for null ids a number beyond all ids. Null, empty and blank texts have no chunk.
    """
    numbered = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.monotonically_increasing_id() + (1 << 62)).alias("doc"),
        "text",
    )

    def cut(batches):
        import pyarrow as pa
        import xxhash

        gear, digest = _gear(), xxhash.xxh3_64_intdigest
        for batch in batches:
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("doc").to_pylist()
            out: list[list] = [[] for _ in range(7)]
            rows = [0] * len(ids)
            for row, text in enumerate(batch.column("text").to_pylist()):
                raw = (text or "").encode()
                if not raw:
                    continue
                data = np.frombuffer(raw, np.uint8)
                ends, words = chunk_ends(data, gear)
                if not len(ends):
                    continue
                begins = np.concatenate([[0], ends[:-1]])
                places = ends if raw.isascii() else np.cumsum((data & 0xC0) != 0x80)[ends - 1]
                out[0].append(np.arange(len(ends)))
                out[1] += [digest(raw[a:b].strip()) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                out[2].append(np.diff(words, prepend=0))
                out[3].append(np.concatenate([[0], places[:-1]]))
                out[4].append(places)
                rows[row] = len(ends)
            counts = np.array(rows)
            joined = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
            index = np.repeat(np.arange(len(ids)), counts)
            arrays = [
                batch.column("doc_id").take(pa.array(index)),
                batch.column("doc").take(pa.array(index)),
                pa.array(joined(out[0]), pa.int64()),
                pa.array(np.array(out[1], np.uint64).astype(np.int64)),
                pa.array(joined(out[2])),
                pa.array(joined(out[3])),
                pa.array(joined(out[4])),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "doc", "chunk", "digest", "n_words", "first", "last"])

    return numbered.mapInArrow(cut, "doc_id bigint, doc bigint, chunk bigint, digest bigint, n_words bigint, first bigint, last bigint")


def repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, doc, first, last, n_words, first_doc_id``: passages that stand further ahead too, in this document or one of smaller id.

    A passage is a run of neighbouring chunks, together ``least_words`` words or
    ``WORD_CHARS`` characters for each of these or more, each of which occurs
    before, in a document that comes before this one or further ahead in this one;
    so the first place of a passage keeps it. ``first_doc_id`` is the first
    document that has any of the run's chunks. Rows of one id count as one document
    (a chunk of the same number in another of them is no repeat); null ids come
    last and are documents of their own. Digests have 64 bits.
    """
    rows = chunks(docs)
    place = F.struct("doc", "chunk")
    seen = rows.groupBy("digest").agg(F.min(place).alias("origin"), F.max(place).alias("latest")).filter("origin <> latest")
    # A table of its own, so that the join can split a chunk that very many documents have.
    seen = settle(seen.select("digest", F.col("origin.doc").alias("origin"), F.col("origin.chunk").alias("origin_chunk")))
    again = rows.join(seen, "digest").filter("doc <> origin or chunk <> origin_chunk")
    # Repeated chunks only, each document for itself: as many rows as it has such chunks.
    in_doc = Window.partitionBy("doc").orderBy("chunk", "first")
    run = again.withColumn("run", F.col("chunk") - F.dense_rank().over(in_doc))
    return (
        run.groupBy("doc", "run")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.sum("n_words").alias("n_words"),
            F.min("origin").alias("origin"),
        )
        .filter((F.col("n_words") >= least_words) | (F.col("last") - F.col("first") >= WORD_CHARS * least_words))
        .select("doc_id", "doc", "first", "last", "n_words", F.when(F.col("origin") < (1 << 62), F.col("origin")).alias("first_doc_id"))
    )


def without_repeats(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with their repeated passages cut out of ``text``; all rows and columns stay.

    Rows that share an id are cut alike, so ids should be unique; rows with a null id stay whole.
    """
    spans = (
        repeated_passages(docs, least_words)
        .filter("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"))
        .select(F.col("doc_id").alias("cut_id"), "spans")
    )
    whole = docs.select(F.struct("*").alias("row"))
    joined = whole.join(spans, F.col("row.doc_id") == F.col("cut_id"), "left")
    # What stands between the spans, and behind the last.
    between = F.expr(
        "array_join(transform(sequence(0, size(spans)), i -> substring(row.text,"
        " cast(if(i = 0, 0, spans[greatest(i - 1, 0)].last) as int) + 1,"
        " cast(if(i = size(spans), char_length(row.text), spans[least(i, size(spans) - 1)].first) - if(i = 0, 0, spans[greatest(i - 1, 0)].last) as int))), '')"
    )
    cut = joined.select(F.col("row").withField("text", F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(between)).alias("row"))
    return cut.select("row.*")
