"""Requests to routes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparsepages.functions.routes import DEFAULT_ROUTES, Route, path_segments, route_match, url_path
from sparsepages.operators.once import computed_once


def classify_routes(
    df: DataFrame,
    url: str = "url",
    routes: Sequence[Route] = DEFAULT_ROUTES,
    outputs: Sequence[str] = ("controller", "action", "id"),
) -> DataFrame:
    """Add ``route`` and the route values of each address; the first template that fits wins."""
    matched = df.withColumn("__path", url_path(F.col(url))).withColumn("__segments", path_segments(F.col("__path")))
    matched = computed_once(matched, "__match", route_match(F.col("__path"), routes, outputs, F.col("__segments")))
    return matched.select(*df.columns, *[F.col("__match")[c].alias(c) for c in ("route", *outputs)])
