"""Reading records by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparsepages.operators.joins import join_unique


def latest_record(catalogue: DataFrame, key: str = "num") -> DataFrame:
    """The record with the largest id; no row for an empty catalogue."""
    top = catalogue.agg(F.max_by(F.struct(*catalogue.columns), key).alias("__top"))
    return top.filter("__top is not null").select("__top.*")


def lookup_id(catalogue: DataFrame, num: int, key: str = "num", template: str | None = None) -> DataFrame:
    """One record by id; the comparison reaches the file scan.

    The id of landed responses is worked out from ``url``, which a scan cannot
    compare. With the address ``template`` the address itself is compared.
    """
    if template is not None:
        return catalogue.filter(F.col("url") == template.replace("{0}", str(num)))
    return catalogue.filter(F.col(key) == num)


def lookup_ids(
    requests: DataFrame,
    catalogue: DataFrame,
    key: str = "num",
    request_id: str | list[str] | None = None,
    **split,
) -> DataFrame:
    """Every request with its record and a ``found`` flag.

    ``catalogue`` has one row per id. ``request_id`` names what tells requests
    for the same id apart; a very popular id is split with it and without it.
    """
    split_by = [request_id] if isinstance(request_id, str) else request_id and list(request_id)
    joined = join_unique(requests, catalogue.withColumn("__hit", F.lit(True)), key, split_by, **split)
    return joined.withColumn("found", F.coalesce("__hit", F.lit(False))).drop("__hit")
