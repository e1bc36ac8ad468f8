"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

Every benchmark text is cut into windows of consecutive words. The shingles of a
window are ordered by their number of occurrences in the corpus; since a window
must lie in a document whole, its rarest shingle alone is a sufficient prefix.
Documents are joined on that shingle, the shingle's place in the window gives the
place where the window would have to begin (positional bound) and end (length
bound), and the words there are compared with the window's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import if_small, settle, without_rows

SHINGLE = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Everything in ASCII that is neither a digit nor a letter separates words.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words with their case as in the text; null has none."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{_GAP}|{_GAP}\z", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _GAP))


def folded(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, _UPPER, _LOWER)


def _shingle(words: str, at: str, width: int) -> Column:
    """Hash of ``width`` words from 1-based place ``at``; case is folded for all letters, so it only ever says too much."""
    return F.expr("xxhash64(" + ", ".join(f"lower(try_element_at({words}, cast({at} + {i} as int)))" for i in range(width)) + ")")


def windows_of(benchmark: DataFrame, window: int) -> DataFrame:
    """``win_id, item_id, win, n``: the windows of every item (words joined by spaces), their hash and number of words."""
    words = benchmark.select(F.col("item_id"), words_of(folded(F.col("text"))).alias("words")).filter("size(words) > 0")
    starts = F.expr(f"sequence(1, greatest(1, size(words) - {window - 1}))")
    cut = words.select("item_id", "words", F.explode(starts).alias("s")).select("item_id", F.slice("words", F.col("s"), window).alias("own"))
    named = cut.select("item_id", F.array_join("own", " ").alias("win"), F.size("own").alias("n"))
    return named.select(F.xxhash64("win").alias("win_id"), "item_id", "win", "n").distinct()


def contaminated_words(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_hash``, one row per row of ``docs``.

    A word is hit if it lies in an occurrence of a window of some item; an item
    of fewer words than a window is one window. Null texts have no words; items
    without words or text have no windows; items with a null id lend their hits
    but are in no list. Repeated rows and ids stay apart, further columns are not
    read. ``items_sha256`` is the SHA-256 of the sorted, comma-joined ids as text,
    of the empty text if there are none. Documents are known by id and text hash,
    windows by a 64-bit hash.

    The windows' prefixes are broadcast as long as they hold no more than
    ``common.BROADCAST_BYTES``, and compared where the words are. Beyond that only
    places and hashes of shingles are shuffled, and the candidates are brought back
    to their documents for the comparison.
    """
    items = settle(windows_of(benchmark, window))
    windows = items.select("win_id", "win", "n").distinct()
    widths = sorted(r[0] for r in windows.select(F.least("n", F.lit(SHINGLE)).alias("w")).distinct().collect())  # at most SHINGLE values
    texts = docs.select(F.col("doc_id"), F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words")).withColumn("n_words", F.size("words"))

    # Shingles of each window with their places: `off` words lie before the shingle.
    width = F.least("n", F.lit(SHINGLE))
    placed = windows.withColumn("words", F.split("win", " ")).select(
        "win_id", "win", "n", "words", width.alias("w"), F.explode(F.expr(f"sequence(0, n - least(n, {SHINGLE}))")).alias("off")
    )
    hashed = F.coalesce(*(F.when(F.col("w") == w, _shingle("words", "off + 1", w)) for w in widths), F.lit(0).cast("bigint"))
    placed = settle(placed.withColumn("key", hashed).drop("words"))

    def shingled(kept: list[str]) -> DataFrame:
        """A row for each place and width, and one with place 0 for each document."""
        places = texts.select(*kept, "words", F.explode(F.expr("sequence(0, n_words)")).alias("at"))
        if not widths:
            return places.filter("at = 0").withColumn("key", F.lit(None).cast("bigint")).withColumn("w", F.lit(None).cast("int"))
        if len(widths) == 1:
            return places.withColumn("key", F.when(F.col("at") > 0, _shingle("words", "at", widths[0]))).withColumn("w", F.lit(widths[0]))
        some = F.explode(F.expr(f"if(at = 0, array(0), array({', '.join(map(str, widths))}))")).alias("w")
        places = places.select(*kept, "words", "at", some)
        return places.withColumn("key", F.coalesce(*(F.when(F.col("w") == w, _shingle("words", "at", w)) for w in widths)))

    # Occurrences in the corpus of the windows' shingles, then the rarest of each window.
    wanted = if_small(settle(placed.select("key").distinct()), 16)
    found = shingled(["n_words"]).select("key").join(wanted, "key").groupBy("key").agg(F.count("*").alias("seen"))
    rated = placed.join(found, "key", "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    prefix = rated.groupBy("win_id", "win", "n").agg(F.min(F.struct("seen", "off", "key", "w")).alias("p"))
    # A window whose rarest shingle is nowhere is nowhere.
    prefix = settle(
        prefix.filter("p.seen > 0").select("win_id", "win", F.col("n").alias("len"), F.col("p.w").alias("pw"), F.col("p.off").alias("off"), F.col("p.key").alias("pkey"))
    )

    doc = ["doc_id", "text_hash"]
    meets = (F.col("key") == F.col("pkey")) & (F.col("w") == F.col("pw"))
    begins = F.col("at") - F.col("off")
    there = (begins >= 1) & (begins + F.col("len") - 1 <= F.col("n_words"))
    same = lambda first: folded(F.array_join(F.expr(f"slice(words, {first}, len)"), " ")) == F.col("win")
    out = [*doc, "n_words", F.when(F.col("at") > 0, begins).otherwise(0).alias("first"), "len", "win_id"]
    known = if_small(prefix, F.octet_length("win") + 64)
    if known is not prefix:
        joined = shingled([*doc, "n_words"]).join(known, meets, "left")
        hits = settle(joined.filter((F.col("at") == 0) | F.when(there, same("at - off")).otherwise(False)).select(*out))
        every = hits.filter("first = 0").select(*doc, "n_words")
        hits = hits.filter("first > 0")
    else:
        narrow = shingled([*doc, "n_words"]).filter("at > 0").select(*doc, "n_words", "at", "key", "w")
        near = narrow.join(prefix.drop("win"), meets).filter(there).select(*out).distinct()
        once = texts.select(*doc, "words").dropDuplicates(doc)
        back = near.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "first", "len", "win_id")
        back = back.join(prefix.select("win_id", "win"), "win_id")
        mine = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash"))
        hits = settle(back.join(once, mine).filter(same("first")).select(*doc, "first", "len", "win_id"))
        every = texts.select(*doc, "n_words")

    # Words are counted once each.
    words_hit = hits.select(*doc, F.explode(F.expr("sequence(first, first + len - 1)")).alias("place")).distinct().groupBy(*doc).agg(F.count("*").alias("n_hit"))
    listed = hits.select(*doc, "win_id").distinct().join(items.select("win_id", "item_id"), "win_id", "left").select(*doc, "item_id").distinct()
    ids = F.array_sort(F.collect_list(F.col("item_id").cast("string")))
    per_doc = words_hit.join(_renamed(listed.groupBy(*doc).agg(ids.alias("ids"))), _same_document()).drop("of_id", "of_hash")
    counts = _renamed(settle(per_doc))
    joined = every.join(if_small(counts, F.expr("aggregate(ids, 64L, (n, x) -> n + length(x) + 16)")), _same_document(), "left")
    listed = F.coalesce("ids", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.size(listed).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
        "text_hash",
    )


def _renamed(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("doc_id", "of_id").withColumnRenamed("text_hash", "of_hash")


def _same_document() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("of_id")) & F.col("text_hash").eqNullSafe(F.col("of_hash"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` without any hit word, with all their columns. Rows are known by id and text."""
    hit = contaminated_words(docs, benchmark, window).filter("contaminated")
    return without_rows(docs, hit.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")))
