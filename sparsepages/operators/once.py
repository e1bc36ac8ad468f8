"""Costly columns that are read more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is worked out once per row, however often it is read.

    Catalyst copies a projected expression into every filter above it; a parse
    or a chain of patterns would then run for the filter and again for the
    output. It copies nothing through a generator, and ``explode`` of exactly
    one element keeps every row. The work itself is done in a projection below,
    where Spark shares common parts of the expression.
    """
    worked_out = df.withColumn("__once", value)
    return worked_out.select(*df.columns, F.explode(F.array("__once")).alias(name))
