"""Counts per (station, source, product), (station, source) and station.

The rules read these instead of joining the snapshot with itself. Each level aggregates the
one below, with partial aggregation before the shuffle, so a station or source that holds a
large part of all rows is spread over many tasks by the finer keys first.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.functions.prices import day, fails_open, with_limits

PRODUCT_KEY = ["station_id", "source", "product_id"]
SOURCE_KEY = ["station_id", "source"]


def product_summary(
    snapshot: DataFrame, as_of: date, bounds: tuple[float, float] = refdata.GLOBAL_BOUNDS
) -> DataFrame:
    """One row per (station, source, product); ``price`` is the lowest of its rows and
    ``shown_beyond`` counts the shown ones outside the bounds for all fuels."""
    shown, hidden = F.col("show_in_report") == "t", F.col("show_in_report") == "f"
    beyond = (F.col("price") < bounds[0]) | (F.col("price") > bounds[1])
    today = F.col("date_upd") == day(as_of)
    return snapshot.groupBy(*PRODUCT_KEY).agg(
        F.min("price").alias("price"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(today).alias("count_fuel"),
        F.count_if(shown).alias("shown"),
        F.count_if(shown & beyond).alias("shown_beyond"),
        F.count_if(hidden & today).alias("hidden_today"),
        F.count_if(hidden & today & (F.col("price") > 0)).alias("fresh"),
    )


def source_summary(snapshot: DataFrame, as_of: date) -> DataFrame:
    """Row counts per (station, source)."""
    shown, hidden = F.col("show_in_report") == "t", F.col("show_in_report") == "f"
    today = F.col("date_upd") == day(as_of)
    return snapshot.groupBy(*SOURCE_KEY).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(today).alias("count_fuel"),
        F.count_if(shown).alias("shown"),
        F.count_if(hidden & today).alias("hidden_today"),
        F.count_if(hidden & today & (F.col("price") > 0)).alias("fresh"),
    )


def count_failing(
    products: DataFrame, limits: Mapping[int, tuple[float, float]] = refdata.PRICE_LIMITS
) -> DataFrame:
    """Row counts per (station, source) of a ``product_summary``, with ``bad``: rows whose
    product's price fails the open interval."""
    per_product = with_limits(products, limits)
    bad = fails_open(F.col("price"), F.col("lo"), F.col("hi"))
    return per_product.groupBy(*SOURCE_KEY).agg(
        F.sum("total").alias("total"),
        F.sum("count_fuel").alias("count_fuel"),
        F.sum("shown").alias("shown"),
        F.sum("hidden_today").alias("hidden_today"),
        F.sum("fresh").alias("fresh"),
        F.sum(F.when(bad, F.col("total")).otherwise(0)).alias("bad"),
    )


def limit_check(
    snapshot: DataFrame, as_of: date, limits: Mapping[int, tuple[float, float]] = refdata.PRICE_LIMITS
) -> DataFrame:
    return count_failing(product_summary(snapshot, as_of), limits)


def judge_sources(
    products: DataFrame,
    limits: Mapping[int, tuple[float, float]] = refdata.PRICE_LIMITS,
    max_error_share: float = refdata.MAX_ERROR_SHARE,
) -> DataFrame:
    """``count_failing`` with the verdict: OK, 'err' above the share, else OK with ``count_err``."""
    too_many = F.col("bad") / F.col("total") > max_error_share
    partial = (F.col("bad") > 0) & ~too_many
    return count_failing(products, limits).select(
        "*",
        F.when(too_many, "err").otherwise("OK").alias("check"),
        F.when(partial, F.col("bad")).alias("count_err"),
    )


def source_quality(
    snapshot: DataFrame,
    as_of: date,
    limits: Mapping[int, tuple[float, float]] = refdata.PRICE_LIMITS,
    max_error_share: float = refdata.MAX_ERROR_SHARE,
) -> DataFrame:
    return judge_sources(product_summary(snapshot, as_of), limits, max_error_share)


def count_fuel(snapshot: DataFrame) -> DataFrame:
    """Rows per (station, source, date) and per (station, source)."""
    per_day = snapshot.groupBy(*SOURCE_KEY, "date_upd").agg(F.count(F.lit(1)).alias("count_fuel"))
    return per_day.withColumn("total", F.sum("count_fuel").over(Window.partitionBy(*SOURCE_KEY)))


def sources_per_station(snapshot: DataFrame) -> DataFrame:
    """Number of distinct sources shown per station."""
    shown = snapshot.where(F.col("show_in_report") == "t").select(*SOURCE_KEY).distinct()
    return shown.groupBy("station_id").agg(F.count("source").alias("count_source"))


def single_source_stations(snapshot: DataFrame) -> DataFrame:
    """Stations that show exactly one source, with its row count."""
    per_source = (
        snapshot.where((F.col("show_in_report") == "t") & F.col("source").isNotNull())
        .groupBy(*SOURCE_KEY)
        .agg(F.count(F.lit(1)).alias("count_fuel_true"))
    )
    return (
        per_source.groupBy("station_id")
        .agg(
            F.count("source").alias("count_source"),
            F.max("source").alias("source"),
            F.max("count_fuel_true").alias("count_fuel_true"),
        )
        .where(F.col("count_source") == 1)
    )


def dark_stations(snapshot: DataFrame, as_of: date) -> DataFrame:
    """Stations that show nothing though a hidden price came in on the day.

    One aggregation says what a semi and an anti join would.
    """
    hidden_new = (
        (F.col("show_in_report") == "f") & (F.col("price") > 0) & (F.col("date_upd") == day(as_of))
    )
    return (
        snapshot.groupBy("station_id")
        .agg(F.count_if(F.col("show_in_report") == "t").alias("shown"), F.count_if(hidden_new).alias("fresh"))
        .where((F.col("shown") == 0) & (F.col("fresh") > 0))
        .select("station_id")
    )
