"""Document fingerprints: threshold-scaled sketches, in DataFrame operations only.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so
sketches of any two documents are samples of one and the same part of it, however
unequal the documents are: they can be merged, and both resemblance and
containment can be estimated. So that short documents have something to compare,
a sketch also keeps its ``LEAST`` smallest hashes in any case, and says up to
where it is complete.

A fingerprint is text: the limit below which it is complete, then the kept hashes
in ascending order, each as 12 hexadecimal digits, joined by commas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

WORDS = 5
PARTS = 16  # one in so many hashes is kept
LEAST = 32
_SPAN = 1 << 48
_SPACE = r"[\x20\x09-\x0D]+"


def split_words(text: Column) -> Column:
    """Runs other than ASCII white space; none for an empty text."""
    trimmed = F.regexp_replace(text, rf"^{_SPACE}|{_SPACE}\z", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE))


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the fingerprint of column ``text`` (not null) as column ``name``.

    Shingles are five consecutive words; fewer words are one shingle, no words none.
    """
    whole, kept = rows.columns, f"_{name}"
    hashed = F.expr(f"transform(if(size({kept}) = 0, array(), sequence(1, greatest(size({kept}) - {WORDS - 1}, 1))), i -> shiftrightunsigned(xxhash64(slice({kept}, i, {WORDS})), 16))")
    rows = rows.withColumn(kept, split_words(F.col(text)))
    rows = rows.withColumn(kept, F.sort_array(F.array_distinct(hashed)))
    rows = rows.withColumn(f"{kept}_n", F.size(F.filter(kept, lambda x: x < _SPAN // PARTS)))
    below, n = F.col(f"{kept}_n"), F.size(kept)
    limit = (
        F.when(n <= F.greatest(below, F.lit(LEAST)), F.lit(_SPAN - 1))
        .when(below >= LEAST, F.lit(_SPAN // PARTS))
        .otherwise(F.try_element_at(kept, F.lit(LEAST)) + 1)
    )
    hashes = F.slice(kept, F.lit(1), F.greatest(below, F.lit(LEAST)))
    digits = F.transform(F.concat(F.array(limit), hashes), lambda x: F.lower(F.lpad(F.hex(x), 12, "0")))
    return rows.select(*whole, F.array_join(digits, ",").alias(name))


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, not again for every element of an array."""
    return F.transform(F.array(value), use)[0]


def _below(a: Column, b: Column, use) -> Column:
    """``use(x, y, limit)`` of the hashes of both sketches below the limit that they share."""

    def cut(p: Column) -> Column:
        limit = F.least(p["a"][0], p["b"][0])
        return F.struct(p["a"].alias("a"), p["b"].alias("b"), limit.alias("limit"))

    def under(p: Column) -> Column:
        x, y = (F.filter(F.slice(p[c], F.lit(2), F.size(p[c])), lambda h: h < p["limit"]) for c in ("a", "b"))
        return F.struct(x.alias("x"), y.alias("y"), p["limit"].alias("limit"))

    both = F.struct(F.split(a, ",").alias("a"), F.split(b, ",").alias("b"))
    return _with(_with(_with(both, cut), under), lambda p: use(p["x"], p["y"], p["limit"]))


def likeness(a: Column, b: Column) -> Column:
    """Estimated shared share of the shingles of both, 0 to 1; 1 for equal fingerprints, also of empty texts."""

    def share(x: Column, y: Column, _limit: Column) -> Column:
        union = F.size(F.array_union(x, y))
        return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(x, y)) / union).cast("double")

    return F.when(a == b, 1.0).otherwise(_below(a, b, share))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1 if ``a`` has none."""
    share = lambda x, y, _: F.when(F.size(x) == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(x)).cast("double")
    return _below(a, b, share)


def merged(a: Column, b: Column) -> Column:
    """The fingerprint of the shingles of both documents together, as far as both are complete."""
    return _below(a, b, lambda x, y, limit: F.array_join(F.concat(F.array(limit), F.array_sort(F.array_union(x, y))), ","))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text, fingerprint`` of every row; a null text counts as empty. Nothing is shuffled."""
    return with_fingerprint(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "fingerprint")


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.hex(F.xxhash64(text)))
    return docs.select(name.alias("key"), "doc_id", text.alias("text"))


def _in_turn(docs: DataFrame) -> DataFrame:
    """``key, before, before_chars``: the document of which each is the next, in descending order, and its length.

    Null ids come last, documents of one id by hash of their text; rows that
    repeat both are one document. The order is a distributed sort; places are
    counted per sorted part, so only one row per part meets in a window.
    """
    keys = _identified(docs).select("key", "doc_id", F.char_length("text").alias("n"))
    one = keys.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("n").alias("n"))
    ordered = settle(one.orderBy(F.col("doc_id").desc_nulls_last(), "key"))
    placed = ordered.select("key", "n", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    parts = placed.groupBy("part").agg(F.count("*").alias("rows"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("first", F.coalesce(F.sum("rows").over(ahead), F.lit(0))).withColumn("total", F.sum("rows").over(Window.partitionBy()))
    placed = settle(placed.join(parts, "part").select("key", "n", (F.col("first") + F.col("at")).alias("place"), "total"))
    after = placed.select(F.pmod(F.col("place") + 1, "total").alias("place"), F.col("key").alias("before"), F.col("n").alias("before_chars"))
    return placed.select("key", "place").join(after, "place").select("key", "before", "before_chars")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, next_doc_id``, one row per row of ``docs``
    (``doc_id, text``; further columns are not read). The edited text has the last
    ``floor(n_chars / 3)`` code points replaced by the first as many, or all, of
    the next document in descending ``doc_id`` order, after the last the first. A
    null text is empty. A single document is its own next.

    Texts are shuffled once; of the next documents only what is needed of them.
    """
    links = _in_turn(docs)
    own = with_fingerprint(_identified(docs), "text", "fingerprint")
    joined = own.join(links, "key")
    following = joined.select(
        F.col("before").alias("key"),
        F.col("doc_id").alias("next_doc_id"),
        F.expr("left(text, cast(floor(before_chars / 3) as int))").alias("head"),
        F.col("fingerprint").alias("next_fingerprint"),
    ).dropDuplicates(["key"])
    mine = joined.select("key", "doc_id", "text", "fingerprint")
    n = F.char_length("text")
    both = (
        mine.join(following, "key")
        .withColumn("n_chars", n.cast("bigint"))
        .withColumn("edited", F.concat(F.expr("left(text, n_chars - floor(n_chars / 3))"), "head"))
        .select("doc_id", "n_chars", "edited", "fingerprint", "next_fingerprint", "next_doc_id")
    )
    made = with_fingerprint(both, "edited", "edited_fingerprint")
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        "next_doc_id",
    )
