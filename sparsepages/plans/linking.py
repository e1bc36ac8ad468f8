"""Linked pages from landed responses.

All plans take responses that carry the id of their address in ``num``. An id
exists when its newest landing is anything but 404: a server error or a body
that cannot be decoded yields no page, yet remains a neighbour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparsepages.operators.lookup import lookup_id
from sparsepages.operators.nearest import clip_next, end_sentinel, largest_id, neighbours
from sparsepages.operators.responses import (
    blank_missing,
    classify_outcome,
    decode_records,
    existing_ids,
    fill_defaults,
    latest_response,
    quarantine,
)
from sparsepages.schema import RECORD, SENTINEL
from sparsepages.sources.landings import url_for

PAGE_TEMPLATE = "/comics/{0}"  # fixed value: the address of a page


def _newest(responses: DataFrame, key: str = "num") -> DataFrame:
    landed = responses.filter(F.col(key).isNotNull())
    return latest_response(landed.select(key, "fetched_at", "status", "body"), key).drop("fetched_at")


def _decoded(newest: DataFrame, schema: T.StructType) -> DataFrame:
    return classify_outcome(fill_defaults(decode_records(newest, schema), schema))


def _ids(responses: DataFrame) -> DataFrame:
    return existing_ids(responses).filter(F.col("num") > SENTINEL)


def classified_records(responses: DataFrame, key: str = "num", schema: T.StructType = RECORD) -> DataFrame:
    """Newest landing per id, decoded, with defaults filled in and an outcome."""
    return _decoded(_newest(responses, key), schema)


def _record_at(responses: DataFrame, url: str, schema: T.StructType) -> DataFrame:
    landed = responses.filter(F.col("url") == url).select("url", "fetched_at", "status", "body")
    good, _ = quarantine(_decoded(latest_response(landed), schema))
    return good.select(F.col("record.num").cast("bigint").alias("num"), "record")


def last_id(
    responses: DataFrame, largest: Column, last_url: str | None = None, schema: T.StructType = RECORD
) -> Column:
    """Upper bound of the search for a next page.

    The number inside the record at ``last_url``, if that address has landed
    and can be decoded; ``largest``, the largest existing id, otherwise.
    """
    if last_url is None:
        return largest
    return F.coalesce(_record_at(responses, last_url, schema).agg(F.max("num")).scalar(), largest)


def _envelope(linked: DataFrame, key: str = "num") -> DataFrame:
    return linked.select(key, F.col("record").alias("result"), "next_page", "prev_page")


def assemble_pages(records: DataFrame, steps: DataFrame, key: str = "num") -> DataFrame:
    """One envelope per record: the record itself and its two neighbours.

    Both sides hold an id once, so no key can be crowded.
    """
    return _envelope(records.join(steps, key), key)


def nav_links(df: DataFrame, template: str = PAGE_TEMPLATE, sentinel: int = SENTINEL) -> DataFrame:
    """Add an address for each neighbour there is; NULL where there is none."""
    for side in ("next", "prev"):
        page = F.col(f"{side}_page")
        df = df.withColumn(f"{side}_url", F.when(page != sentinel, url_for(page, template)))
    return df


def pages(
    responses: DataFrame, last_url: str | None = None, schema: T.StructType = RECORD, **options
) -> DataFrame:
    """Every page of the collection, linked.

    Ids are found from three narrow columns in a branch of their own. Bodies
    are shuffled once, by id, to pick the newest, without those of landings that
    found nothing; that leaves them partitioned and sorted for the join, where
    only ``steps`` moves, and the join drops what was not found before any text
    is parsed. ``options`` go to ``neighbours``.
    """
    ids = _ids(responses)
    steps = neighbours(ids, unique=True, **options)
    if last_url is not None:
        last = last_id(responses, largest_id(ids), last_url, schema)
        steps = steps.withColumn("next_page", clip_next(F.col("next_page"), last))
    good, _ = quarantine(_decoded(_newest(blank_missing(responses)).join(steps, "num"), schema))
    return nav_links(_envelope(good))


def page_of(
    responses: DataFrame,
    num: int,
    last_url: str | None = None,
    template: str | None = None,
    schema: T.StructType = RECORD,
) -> DataFrame:
    """The page of one id; no row when it is missing or malformed.

    One aggregate over the ids, to a single row, instead of the page table. With
    the address ``template`` the scan reads no bodies but those of the page.
    """
    at = F.lit(num).cast("bigint")
    near = _ids(responses).agg(
        F.max("num").alias("largest"),
        F.min(F.when(F.col("num") > at, F.col("num"))).alias("after"),
        F.max(F.when(F.col("num") < at, F.col("num"))).alias("before"),
    )
    last = last_id(responses, F.col("largest"), last_url, schema)
    steps = near.select(
        F.struct(
            clip_next(F.col("after"), last).alias("next_page"),
            end_sentinel(F.col("before")).alias("prev_page"),
        )
    ).scalar()
    asked = lookup_id(responses, num, template=template).filter(F.col("num") > SENTINEL)
    good, _ = quarantine(classified_records(blank_missing(asked), schema=schema))
    return nav_links(
        good.select(
            "num",
            F.col("record").alias("result"),
            steps["next_page"].alias("next_page"),
            steps["prev_page"].alias("prev_page"),
        )
    )


def home_page(
    responses: DataFrame,
    last_url: str | None = None,
    template: str | None = None,
    schema: T.StructType = RECORD,
) -> DataFrame:
    """The page of the newest record; nothing follows it.

    The newest record is the one at ``last_url``, numbered by the id inside it;
    without such an address it is the one with the largest existing id, read by
    its address if the ``template`` is given. Only that record is decoded, and
    once. No row when it cannot be.
    """
    ids = _ids(responses)
    if last_url is None:
        top = ids.orderBy(F.col("num").desc()).limit(2)
        top = top.agg(F.max("num").alias("num"), F.when(F.count("*") == 2, F.min("num")).alias("before"))
        if template is None:
            newest = responses.filter(F.col("num") == top.select("num").scalar())
        else:
            newest = responses.filter(F.col("url") == top.select(url_for(F.col("num"), template)).scalar())
        newest = quarantine(classified_records(newest, schema=schema))[0]
        newest = newest.select("num", "record", top.select("before").scalar().alias("before"))
    else:
        # One row; the ids below it are counted against that same row.
        record = _record_at(responses, last_url, schema).select(F.struct("num", "record")).scalar()
        newest = (
            ids.withColumn("__top", record)
            .agg(F.max(F.when(F.col("num") < F.col("__top.num"), F.col("num"))).alias("before"))
            .select(record.alias("__top"), "before")
            .filter("__top is not null")
            .select("__top.num", "__top.record", "before")
        )
    return nav_links(
        newest.select(
            "num",
            F.col("record").alias("result"),
            F.lit(SENTINEL).cast("bigint").alias("next_page"),
            end_sentinel(F.col("before")).alias("prev_page"),
        )
    )
