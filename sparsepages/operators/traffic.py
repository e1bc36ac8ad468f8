"""Filters over a request log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Words that mark a user agent as synthetic.
SYNTHETIC_WORDS = ("search", "spider", "crawl", "Bot", "Monitor", "AlwaysOn")

# Handlers whose requests are not recorded.
EXCLUDED_HANDLERS = (
    "System.Web.Handlers.TransferRequestHandler",
    "Microsoft.VisualStudio.Web.PageInspector.Runtime.Tracing.RequestDataHttpHandler",
    "System.Web.StaticFileHandler",
    "System.Web.Handlers.AssemblyResourceLoader",
    "System.Web.Optimization.BundleHandler",
    "System.Web.Script.Services.ScriptHandlerFactory",
    "System.Web.Handlers.TraceHandler",
    "System.Web.Services.Discovery.DiscoveryRequestHandler",
    "System.Web.HttpDebugHandler",
)

ITEMS_PER_SECOND = 5  # fixed value: the target rate

# Parts into which a time bucket is dealt, one round after the other.
_DEALS = (4096, 64, 1)

# A time bucket holding more than one request in this many is crowded.
_CROWDED = 65_536


def tag_synthetic(
    requests: DataFrame,
    agent: str = "user_agent",
    words: Sequence[str] = SYNTHETIC_WORDS,
    match_case: bool = False,
    out: str = "is_synthetic",
) -> DataFrame:
    """Add a flag: does the user agent contain one of the words? No row is dropped."""
    text = F.col(agent) if match_case else F.lower(agent)
    tests = [F.contains(F.col("__agent"), F.lit(w if match_case else w.lower())) for w in words]
    found = reduce(lambda a, b: a | b, tests, F.lit(False))
    tagged = requests.withColumn("__agent", text).withColumn(out, F.coalesce(found, F.lit(False)))
    return tagged.drop("__agent")


def exclude_handlers(
    requests: DataFrame, handler: str = "handler", handlers: Sequence[str] = EXCLUDED_HANDLERS
) -> DataFrame:
    """Drop requests served by a listed handler; those without one are kept.

    The list is configuration, so it is a literal set in the filter and reaches
    the scan; there is nothing to join.
    """
    return requests.filter(F.col(handler).isNull() | ~F.col(handler).isin(*handlers))


def time_bucket(ts: Column, kind: T.DataType, seconds: int) -> Column:
    """Number of the ``seconds``-long bucket since 1970, whatever the session's time zone."""
    if isinstance(kind, T.TimestampType):
        elapsed = F.unix_seconds(ts)
    else:
        # Counted from year 1, so that cutting off the fraction rounds down.
        since = (ts - F.expr("timestamp_ntz'0001-01-01 00:00:00'")).cast("interval second").cast("bigint")
        elapsed = since - F.lit(62_135_596_800)
    size = F.lit(seconds).cast("bigint")
    return F.call_function("div", elapsed - F.pmod(elapsed, size), size)


def cap_rate(
    requests: DataFrame,
    limit: int = ITEMS_PER_SECOND,
    seconds: int = 1,
    ts: str = "ts",
    request_id: str = "request_id",
    by: Sequence[str] = (),
) -> DataFrame:
    """Keep the first ``limit`` requests of every time bucket, by time and id.

    A bucket is dealt into many parts, then fewer, then one, each capped on its
    own: the first ``limit`` overall are among the first ``limit`` of their part,
    so the result is the same, and after the first round no task ranks more than
    64 times ``limit`` rows of a bucket, however crowded it is and whatever the
    limit. Each round caps in the map tasks as well where Spark does that.
    """
    bucket = time_bucket(F.col(ts), requests.schema[ts].dataType, seconds)
    capped = requests.withColumn("__bucket", bucket)
    # A request without a time belongs to no bucket: it gets one of its own.
    groups = ["__bucket", F.when(F.col("__bucket").isNull(), F.col(request_id)), *by]
    for parts in _DEALS:
        part = [F.pmod(F.xxhash64(request_id), F.lit(parts))] if parts > 1 else []
        order = Window.partitionBy(*groups, *part).orderBy(ts, request_id)
        capped = capped.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= limit)
    return capped.select(*requests.columns)


def sample_hash(request_id: Column) -> Column:
    """32 bits of a digest of the id, as a number; the same on every run and in every engine."""
    return F.conv(F.substring(F.md5(request_id.cast("string")), 1, 8), 16, 10).cast("bigint")


def sample_rate(
    requests: DataFrame,
    limit: int = ITEMS_PER_SECOND,
    seconds: int = 1,
    ts: str = "ts",
    request_id: str = "request_id",
) -> DataFrame:
    """Keep about ``limit`` requests per time bucket by hash, with ``item_weight`` = how many each stands for.

    A request stays if ``hash * n < limit * 2**32``, n being the size of its
    bucket. The bound on the hash is worked out once per bucket, by whole
    division, so nothing overflows in a crowded one. Requests without a time
    belong to no bucket and stay with weight 1.

    The bounds of the crowded buckets, those holding more than one request in
    ``_CROWDED``, are broadcast: there are fewer than ``_CROWDED`` of them by
    that definition. Their requests are thinned where they are read, before
    anything is shuffled to meet the bounds of all other buckets.
    """
    bucket = time_bucket(F.col(ts), requests.schema[ts].dataType, seconds)
    rows = requests.withColumn("__bucket", bucket)
    sizes = rows.filter(F.col("__bucket").isNotNull()).groupBy("__bucket").agg(F.count("*").alias("n"))
    bounds = sizes.withColumn("__bound", F.expr(f"({limit} * 4294967296L - 1) div n"))
    fair = sizes.agg(F.expr(f"(sum(n) + {_CROWDED - 1}) div {_CROWDED}")).scalar()
    crowded = bounds.filter((F.col("n") > limit) & (F.col("n") > fair)).select("__bucket", "__bound")

    # The digest is only worked out for requests of buckets over the limit.
    below = sample_hash(F.col(request_id)) <= F.col("__bound")
    thinned = rows.join(F.broadcast(crowded), "__bucket", "left").filter(F.col("__bound").isNull() | below)
    # Requests without a time match no bucket; far below all bucket numbers
    # they keep apart from each other as well.
    apart = F.lit(-(2**62)) - F.pmod(F.xxhash64(request_id), F.lit(2**31))
    keyed = thinned.withColumn("__bucket", F.coalesce("__bucket", apart)).drop("__bound")
    sized = keyed.join(bounds, "__bucket", "left")
    kept = sized.filter(F.col("n").isNull() | (F.col("n") <= limit) | below)
    weight = F.greatest(F.lit(1.0), F.col("n") / F.lit(float(limit)))
    return kept.select(*requests.columns, F.coalesce(weight, F.lit(1.0)).alias("item_weight"))
