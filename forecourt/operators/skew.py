"""Joins that stay splittable when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_apart(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """``df.groupBy(*keys).agg(*aggregates)`` to be joined with a larger table on ``keys``.

    AQE splits a hot join key only where both sides come straight from a shuffle. An
    aggregate on the join keys would be joined without one. Grouping by a struct of them
    makes Spark shuffle the result, the smaller side, once more.
    """
    key = F.struct(*keys).alias("_key")
    grouped = df.groupBy(key).agg(*aggregates) if aggregates else df.select(key).distinct()
    return grouped.select(*(F.col(f"_key.{k}").alias(k) for k in keys), *(c for c in grouped.columns if c != "_key"))
