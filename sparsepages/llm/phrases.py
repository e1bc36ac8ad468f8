"""Phrase collocation mining by vertical partitioning of word suffixes.

Phrases are prefixes of suffixes of pieces, cut after ``MOST_WORDS`` words. The
suffixes are divided by their first word; where that word alone would begin more
suffixes than the memory budget allows, by the first two, and so on. Each group of
prefixes is a sorted run of suffixes in one task, the subtree of its prefixes
written out, and the count of a phrase is the total of the leaves below it. A
suffix ends before a word or a pair of words that is too rare for any phrase. Pairs
have been counted by then, so only longer suffixes are dealt.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, if_small, settle, small_batches
from .pieces import binaries, bytes_of, slices

MOST_WORDS = 5
LEAST = 100  # occurrences of a phrase
TOP = 2000  # phrases of a language
GROUP_ROWS = 1 << 19  # suffixes that begin alike, beyond which their prefix is made longer
MOST_HEAVY = 1 << 16  # words that can be too frequent for one group
NUMBER_BYTES, CODE_BYTES = 3, 8  # of a word in a key
NUMBERED = min(BROADCAST_BYTES // 8, (1 << 8 * NUMBER_BYTES) - 1)  # frequent words, beyond which keys have codes
FILTER_BITS = 1 << 27  # of the table that says which words or pairs may be frequent: 16 MB at any size of the corpus

_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_KIND = np.zeros(256, np.uint8)  # 0 in a word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))

# Exact: neither product passes 38 digits, and the quotient no more than 1000 n.
SCORE = "(1000 * cast(a as decimal(18, 0)) * cast(n as decimal(16, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"


class Words:
    """The words of a slice in order: ``codes`` of language and word, ``run`` (the number of their piece), ``word`` and ``lang`` by number."""

    def __init__(self, texts, langs: list[str | None]):
        import xxhash

        data, starts = bytes_of(texts)
        upper = (data >= 65) & (data <= 90)
        data = data + (upper << 5).astype(np.uint8)
        kind = _KIND[data]
        inside = kind == 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        begins = starts[:-1][np.diff(starts) > 0]
        first[begins] = inside[begins]
        ends = begins[begins > 0] - 1
        last[ends] = inside[ends]
        at = np.flatnonzero(first)
        text = np.searchsorted(starts, at, side="right") - 1
        self.run = np.searchsorted(np.flatnonzero(kind == 2), at) + text
        offsets = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - at)])
        coded = binaries(data[inside], offsets).dictionary_encode()
        self.distinct, self.word = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self.langs = list(dict.fromkeys(x if x is not None else "und" for x in langs))
        number = {x: i for i, x in enumerate(self.langs)}
        self.lang = np.array([number[x if x is not None else "und"] for x in langs], np.int64)[text]
        of_word = np.array([xxhash.xxh3_64_intdigest(w) for w in self.distinct], np.uint64)
        of_lang = np.array([xxhash.xxh64_intdigest(x) for x in self.langs], np.uint64)
        self.codes = _mixed(of_word[self.word] * _ODD ^ of_lang[self.lang])


def _may_hold(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    place = codes & np.uint64(FILTER_BITS - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _filter(codes: DataFrame) -> np.ndarray:
    """A bit for each of ``FILTER_BITS`` remainders of ``code``: at most 4096 rows of 4 kB come to the driver."""
    place = codes.select((F.pmod("code", F.lit(FILTER_BITS)) + 1).alias("x"))
    rows = place.groupBy(F.bitmap_bucket_number("x").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows:
        start = (r["bucket"] - 1) * 4096
        out[start : start + 4096] = np.frombuffer(r["bits"], np.uint8)[: len(out) - start]
    return out


# Pairs of numbers are crowded in the filter unless their first words are spread over it.
SPREAD = "code ^ (shiftrightunsigned(code, 24) << 11)"


def _spread(codes: np.ndarray) -> np.ndarray:
    return codes ^ (codes >> np.uint64(24) << np.uint64(11))


class Names:
    """What stands for a frequent word in keys: its number from 1 among the sorted codes or, of too many words for that, its code."""

    def __init__(self, frequent: DataFrame):
        if frequent.count() <= NUMBERED:
            found = frequent.select("code").toArrow().column("code").to_numpy()
            self.codes, self.width = np.sort(found.view(np.uint64)), NUMBER_BYTES
        else:
            self.codes, self.width, self.bits = None, CODE_BYTES, _filter(frequent)

    @property
    def shortest(self) -> int:
        """Words of the shortest suffixes that are dealt; the code of a pair of numbers is its key."""
        return 2 if self.codes is None else 3

    def pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        if self.codes is None:
            return _mixed(first * _ODD ^ second)
        return first.astype(np.uint64) << np.uint64(8 * NUMBER_BYTES) | second

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The names of words, and which words are frequent; with codes a few more, which only costs work."""
        if self.codes is None:
            return codes, _may_hold(self.bits, codes)
        if not len(self.codes):
            return np.zeros(len(codes), np.uint32), np.zeros(len(codes), bool)
        place = np.searchsorted(self.codes, codes)
        place[place == len(self.codes)] = 0
        return (place + 1).astype(np.uint32), self.codes[place] == codes


class Suffixes:
    """Suffixes of frequent words and pairs, as long as are dealt: ``at`` where they begin, ``length`` in words, ``depth`` the words by which each is dealt, ``pairs`` the codes of their first two."""

    def __init__(self, words: Words, names: Names, pair_bits: np.ndarray | None = None, heavy: np.ndarray = (), heavy_pairs: np.ndarray = ()):
        self.shortest = names.shortest
        name, known = names.of(words.codes)
        self.words = np.concatenate([name, np.zeros(MOST_WORDS, name.dtype)])
        pair = np.zeros(len(self.words), bool)  # does the word belong together with the next?
        pair[: max(0, len(name) - 1)] = known[:-1] & known[1:] & (words.run[:-1] == words.run[1:])
        self.at = np.flatnonzero(pair)
        self.pairs = names.pairs(name[self.at], name[self.at + 1])
        if pair_bits is None:
            return
        keep = _may_hold(pair_bits, _spread(self.pairs))
        pair[self.at[~keep]] = False
        self.at, self.pairs = self.at[keep], self.pairs[keep]
        self.length = np.full(len(self.at), 2, np.int8)
        going = np.ones(len(self.at), bool)
        for k in range(3, MOST_WORDS + 1):
            going &= pair[self.at + k - 2]
            self.length += going
        # One word more than its longest prefix of heavy words and pairs, as far as it goes. A prefix is as frequent as its rarest pair at most.
        self.depth = np.ones(len(self.at), np.int8)
        if len(heavy):
            going = np.isin(self.words[self.at], heavy) & (self.length > 1)
            self.depth += going
            heavy_here = np.zeros(len(self.words), bool)
            heavy_here[self.at] = np.isin(self.pairs, heavy_pairs)
            for k in range(2, MOST_WORDS):
                going &= heavy_here[self.at + k - 2] & (self.length > k)
                self.depth += going
        if names.shortest > 2:
            long = self.length >= names.shortest
            self.at, self.length, self.depth = self.at[long], self.length[long], self.depth[long]

    def leaves(self):
        """Distinct ones, in parts: a code, how many, words, words by which they are dealt, and their words, one row each; what lies beyond their length means nothing."""
        code = self.words[self.at].astype(np.uint64)
        whole = np.zeros(len(code), np.uint64)
        for k in range(2, MOST_WORDS + 1):
            code = _mixed(code * _ODD ^ self.words[self.at + k - 1])
            own = code ^ np.uint64(k)
            whole = np.where(self.length == k, own, whole)
            below = np.flatnonzero(self.depth > k)
            if len(below) and k >= self.shortest:  # a prefix that was made longer is a leaf of its own for each suffix below it
                yield self._distinct(own[below], below, np.full(len(below), k, np.int8), np.full(len(below), k, np.int8))
        if len(whole):
            yield self._distinct(whole, np.arange(len(whole)), self.length, self.depth)

    def _distinct(self, whole, which, length, depth):
        whole, first, n = np.unique(whole, return_index=True, return_counts=True)
        return whole, n, length[first], depth[first], self.words[self.at[which[first]][:, None] + np.arange(MOST_WORDS)[None, :]]


def packed(matrix: np.ndarray, lengths: np.ndarray, width: int):
    """An Arrow array of the first words of each row, as ``width`` bytes each that sort like the words."""
    import pyarrow as pa

    kept = np.arange(MOST_WORDS)[None, : matrix.shape[1]] < lengths[:, None]
    data = matrix[kept].astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :]
    return binaries(data.ravel(), np.concatenate([[0], width * np.cumsum(lengths)])).cast(pa.binary())


def unpacked(keys, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of keys that ``packed`` made: the words of each, 0 behind the last, and how many."""
    _, offsets, data = keys.buffers()
    starts = np.frombuffer(offsets, np.int32)[keys.offset : keys.offset + len(keys) + 1]
    lengths = np.diff(starts) // width
    own = np.zeros((lengths.sum(), 8), np.uint8)
    own[:, 8 - width :] = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]].reshape(-1, width)
    matrix = np.zeros((len(keys), MOST_WORDS), np.uint64)
    matrix[np.arange(MOST_WORDS)[None, :] < lengths[:, None]] = own.view(">u8").ravel()
    return matrix, lengths


def _mapped(docs: DataFrame, make, schema: str) -> DataFrame:
    """``make`` takes the words of slices, one after the other, and gives columns."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        import pyarrow as pa

        def all_words():
            for batch in batches:
                langs = batch.column("lang").to_pylist()
                for first, texts in slices(batch):
                    words = Words(texts, langs[first : first + len(texts)])
                    if len(words.codes):
                        yield words

        for columns in make(all_words()):
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("lang", "text").mapInArrow(run, schema)


HELD_BYTES = 32_000_000  # of rows that a task adds up before it gives them away


def _added_up(parts):
    """Rows ``(code, n, further columns)`` with equal codes as one, over as many slices as ``HELD_BYTES`` allow."""
    held, size = [], 0
    bytes_in = lambda part: sum(x.nbytes for x in part)

    def given():
        code, n, *more = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(code, kind="stable")
        code = code[order]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        return code[first], np.add.reduceat(n[order], first), *(x[order[first]] for x in more)

    for part in parts:
        held.append(part)
        size += bytes_in(part)
        if size > HELD_BYTES:
            held = [given()]
            size = bytes_in(held[0])
            if 2 * size > HELD_BYTES:
                yield held[0]
                held, size = [], 0
    if size:
        yield given()


def _signed(codes: np.ndarray):
    import pyarrow as pa

    return pa.array(codes.view(np.int64))


def word_counts(docs: DataFrame) -> DataFrame:
    """``code, lang, n``: the occurrences of every word in its language. Words combine per slice and task before the shuffle."""

    def count(slices):
        import pyarrow as pa

        number: dict[str, int] = {}  # of a language, in this task

        def distinct():
            for words in slices:
                codes, first, n = np.unique(words.codes, return_index=True, return_counts=True)
                own = np.array([number.setdefault(x, len(number)) for x in words.langs], np.int32)
                yield codes, n, own[words.lang[first]]

        for codes, n, lang in _added_up(distinct()):
            yield [_signed(codes), pa.array(list(number), pa.string()).take(pa.array(lang)), pa.array(n.astype(np.int64))]

    counted = _mapped(docs, count, "code bigint, lang string, n bigint")
    return settle(counted.groupBy("code", "lang").agg(F.sum("n").alias("n")))


def _spelled(docs: DataFrame, codes: DataFrame) -> DataFrame:
    """``code, word`` for the codes of a table."""
    wanted = docs.sparkSession.sparkContext.broadcast(_filter(codes))

    def spell(slices):
        import pyarrow as pa

        for words in slices:
            codes, first = np.unique(words.codes, return_index=True)
            some = _may_hold(wanted.value, codes)
            own = [words.distinct[i] for i in words.word[first[some]].tolist()]
            yield [_signed(codes[some]), pa.array(own, pa.binary()).cast(pa.string())]

    return _mapped(docs, spell, "code bigint, word string").join(codes, "code", "left_semi").distinct()


def _pair_counts(docs: DataFrame, names) -> DataFrame:
    """``code, n`` of the pairs of words that occur ``LEAST`` times or more."""

    def count(slices):
        import pyarrow as pa

        for codes, n in _added_up(np.unique(Suffixes(words, names.value).pairs, return_counts=True) for words in slices):
            yield [_signed(codes), pa.array(n.astype(np.int64))]

    return settle(_mapped(docs, count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST))


def _keyed(frequent: DataFrame, names) -> DataFrame:
    """``frequent`` with the ``key`` of each word."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            codes = batch.column("code").to_numpy().view(np.uint64)
            key = packed(names.value.of(codes)[0][:, None], np.ones(len(codes), np.int64), names.value.width)
            yield pa.RecordBatch.from_arrays([key, *(batch.column(c) for c in ("code", "lang", "n"))], names=["key", "code", "lang", "n"])

    return frequent.select("code", "lang", "n").mapInArrow(run, "key binary, code bigint, lang string, n bigint")


def _subtrees(rows, names: Names):
    """Phrases and their counts from batches of suffixes (``key, depth, n``) in ascending order.

    A suffix counts for its prefixes of ``depth`` words or more. Of each length the
    last prefix is held back until the next batch shows whether it goes on.
    """
    import pyarrow as pa

    width = names.width
    held = {k: (b"", 0) for k in range(names.shortest, MOST_WORDS + 1)}

    def given(found):
        keys, n = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(n, pa.int64())], names=["key", "a"])

    for batch in rows:
        if not batch.num_rows:
            continue
        keys, found = batch.column("key"), []
        matrix, lengths = unpacked(keys, width)
        least, n = (batch.column(c).to_numpy() for c in ("depth", "n"))
        new = np.ones(len(keys), bool)
        new[1:] = matrix[1:, 0] != matrix[:-1, 0]
        for k in range(2, MOST_WORDS + 1):
            new[1:] |= matrix[1:, k - 1] != matrix[:-1, k - 1]
            if k < names.shortest:
                continue
            begins = np.flatnonzero(new)
            totals = np.add.reduceat(np.where((lengths >= k) & (least <= k), n, 0), begins)
            # A run of shorter suffixes has no prefix of k words, and a total of 0.
            name = lambda i: keys[int(i)].as_py()[: width * k]  # noqa: B023, E731
            before, more = held[k]
            if name(begins[0]) == before:
                totals[0] += more
            elif more >= LEAST:
                found.append((before, more))
            for j in np.flatnonzero(totals[:-1] >= LEAST).tolist():
                found.append((name(begins[j]), int(totals[j])))
            held[k] = name(begins[-1]), int(totals[-1])
        if found:
            yield given(found)
    if found := [x for x in held.values() if x[1] >= LEAST]:
        yield given(found)


def phrase_counts(docs: DataFrame, words: DataFrame, names) -> DataFrame:
    """``key, a``: every phrase of 2 to ``MOST_WORDS`` words with ``LEAST`` occurrences or more, from the frequent ``words`` and their broadcast ``names``."""
    width = names.value.width
    pairs = _pair_counts(docs, names)
    pair_bits = docs.sparkSession.sparkContext.broadcast(_filter(pairs.select(F.expr(SPREAD).alias("code"))))
    n_suffixes = pairs.agg(F.sum("n")).first()[0] or 0
    # No more than MOST_HEAVY words can occur more often than this.
    budget = max(GROUP_ROWS, (words.agg(F.sum("n")).first()[0] or 0) // MOST_HEAVY)
    over = lambda df: np.array([r[0] for r in df.filter(F.col("n") > budget).select("code").collect()], np.int64).view(np.uint64)
    heavy, heavy_pairs = names.value.of(over(words))[0], over(pairs)

    def leaves(slices):
        for words in slices:
            yield from Suffixes(words, names.value, pair_bits.value, heavy, heavy_pairs).leaves()

    def deal(slices):
        import pyarrow as pa

        for _, n, lengths, depths, matrix in _added_up(leaves(slices)):
            yield [packed(matrix, lengths.astype(np.int64), width), pa.array(depths.astype(np.int32)), pa.array(n.astype(np.int64))]

    suffixes = _mapped(docs, deal, "key binary, depth int, n bigint")
    groups = int(min(100_000, max(1, -(-n_suffixes // GROUP_ROWS))))
    dealt = suffixes.repartition(groups, F.expr(f"substring(key, 1, {width} * depth)")).sortWithinPartitions("key")
    longer = settle(dealt.mapInArrow(lambda rows: _subtrees(rows, names.value), "key binary, a bigint"))
    if names.value.shortest == 2:
        return longer
    return settle(longer.unionByName(pairs.select(F.expr(f"unhex(lpad(hex(code), {4 * width}, '0'))").alias("key"), F.col("n").alias("a"))))


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    ``docs`` has ``lang`` (null: ``und``) and ``text`` (null: empty); further
    columns are not read. Texts, A-Z in lower case, are split at ``. , ; : ! ?``
    and line ends into pieces, and those at spaces and tabs into words. ``n`` are
    all words of the language, ``a`` the occurrences of the phrase within pieces,
    ``l`` and ``r`` those of its two parts at the cut with the least
    ``score = floor(1000 * a * n / (l * r))``, the earliest of equal ones. A phrase
    inside a longer one that is as frequent is left out. Ties in score go to the
    greater ``a``, then to the smaller phrase in byte order. Empty tables, and
    texts without words, give no row.

    Words are known by 64-bit hashes of language and word.
    """
    small_batches(docs.sparkSession)
    words = word_counts(docs)
    totals = settle(words.groupBy("lang").agg(F.sum("n").alias("n")))
    frequent = settle(words.filter(F.col("n") >= LEAST))
    names = docs.sparkSession.sparkContext.broadcast(Names(frequent))
    w = names.value.width
    frequent = settle(_keyed(frequent, names))
    found = phrase_counts(docs, frequent, names)
    counts = settle(found.unionByName(frequent.select("key", F.col("n").alias("a"))))

    cuts = found.select("key", "a", F.explode(F.expr(f"sequence(1, length(key) div {w} - 1)")).alias("cut"))
    cuts = cuts.select("key", "a", "cut", F.expr(f"substring(key, 1, {w} * cut)").alias("left"), F.expr(f"substring(key, {w} * cut + 1)").alias("right"))
    side = lambda name, count: counts.select(F.col("key").alias(name), F.col("a").alias(count))
    first = frequent.select(F.col("key").alias("head"), "lang")
    rated = (
        cuts.join(side("left", "l"), "left")
        .join(side("right", "r"), "right")
        .withColumn("head", F.expr(f"substring(key, 1, {w})"))
        .join(first, "head")
        .join(if_small(totals), "lang")
        .withColumn("score", F.expr(SCORE))
        .groupBy("key", "lang", "a", "n")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    )
    # Parts of two words or more of longer phrases, and the greatest count of a phrase that has them.
    spans = f"flatten(transform(sequence(0, k - 2), i -> transform(sequence(2, k - i), m -> substring(key, {w} * i + 1, {w} * m))))"
    inner = found.withColumn("k", F.expr(f"cast(length(key) div {w} as int)")).filter("k > 2")
    inner = inner.select("key", "a", F.explode(F.expr(spans)).alias("part")).filter("part <> key")
    around = inner.groupBy("part").agg(F.max("a").alias("longer"))
    kept = rated.join(around, F.col("key") == F.col("part"), "left").filter(F.coalesce("longer", F.lit(0)) < F.col("a"))
    kept = kept.select("key", "lang", "a", "n", "best.score", "best.l", "best.r")

    # Ties at the end stay until the phrases are spelled out.
    order = [F.col("score").desc(), F.col("a").desc()]
    near = settle(kept.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("place") <= top).drop("place"))
    spelled = near.select("key", F.explode(F.expr(f"sequence(0, cast(length(key) div {w} as int) - 1)")).alias("i"))
    spelled = spelled.withColumn("head", F.expr(f"substring(key, {w} * i + 1, {w})"))
    spelled = settle(spelled.join(frequent.select(F.col("key").alias("head"), "code"), "head").select("key", "i", "code"))
    spelled = spelled.join(_spelled(docs, spelled.select("code").distinct()), "code").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("w"))
    phrases = near.join(spelled, "key").withColumn("phrase", F.array_join("w.word", " "))
    ranked = phrases.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("bigint"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
