"""Rules that hide prices by age, bounds or duplication."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.functions.prices import day
from forecourt.operators.changes import change


def expired_sources(snapshot: DataFrame, as_of: date, sources: Iterable[str], days: int) -> DataFrame:
    """(station, source) that show a row older than ``days``."""
    return (
        snapshot.where(
            F.col("source").isin(*sources)
            & (F.col("show_in_report") == "t")
            & (F.col("date_upd") < day(as_of, -days))
        )
        .select("station_id", "source")
        .distinct()
    )


def off_expired(
    snapshot: DataFrame, as_of: date, classes: Iterable[tuple[str, Iterable[str], int]]
) -> DataFrame:
    """Expiry changes of several disjoint classes of sources (rule, sources, days) in one pass."""
    rule, limit = F.lit(None).cast("string"), F.lit(None).cast("date")
    for name, sources, days in classes:
        is_old = F.col("source").isin(*sources) & (F.col("date_upd") < day(as_of, -days))
        rule, limit = F.when(is_old, name).otherwise(rule), F.when(is_old, day(as_of, -days)).otherwise(limit)
    keys = (
        snapshot.where(F.col("show_in_report") == "t")
        .select("station_id", "source", rule.alias("rule"), limit.alias("to_date"))
        .where(F.col("rule").isNotNull())
        .distinct()
    )
    return change(keys, F.col("rule"), "f", to_date=F.col("to_date"), grain="source")


def off_expired_trusted(
    snapshot: DataFrame,
    as_of: date,
    sources: Iterable[str] = refdata.TRUSTED_SOURCES,
    days: int = refdata.TRUSTED_EXPIRY_DAYS,
) -> DataFrame:
    keys = expired_sources(snapshot, as_of, sources, days)
    return change(keys, "off_expired_trusted", "f", to_date=day(as_of, -days), grain="source")


def off_expired_untrusted(
    snapshot: DataFrame,
    as_of: date,
    sources: Iterable[str] = refdata.UNTRUSTED_SOURCES,
    days: int = refdata.UNTRUSTED_EXPIRY_DAYS,
) -> DataFrame:
    keys = expired_sources(snapshot, as_of, sources, days)
    return change(keys, "off_expired_untrusted", "f", to_date=day(as_of, -days), grain="source")


def out_of_bounds(snapshot: DataFrame, bounds: tuple[float, float] = refdata.GLOBAL_BOUNDS) -> DataFrame:
    """Shown (station, source, product) with a price beyond the bounds for all fuels."""
    low, high = bounds
    return (
        snapshot.where((F.col("show_in_report") == "t") & ((F.col("price") < low) | (F.col("price") > high)))
        .select("station_id", "source", "product_id")
        .distinct()
    )


def off_out_of_bounds(snapshot: DataFrame, bounds: tuple[float, float] = refdata.GLOBAL_BOUNDS) -> DataFrame:
    return change(out_of_bounds(snapshot, bounds), "off_out_of_bounds", "f", grain="source_product")


def off_products_beyond(products: DataFrame) -> DataFrame:
    """``off_out_of_bounds`` from a ``product_summary``."""
    keys = products.where(F.col("shown_beyond") > 0).select("station_id", "source", "product_id")
    return change(keys, "off_out_of_bounds", "f", grain="source_product")


def diesel_duplicates(snapshot: DataFrame, products: Iterable[int] = refdata.DIESEL_PRODUCTS) -> DataFrame:
    """Stations that show several diesel rows at one price, with the oldest row's product.

    A missing price counts as one more price. Rows of one date are taken by product.
    """
    price, rows = F.col("price"), F.count(F.lit(1))
    one_price = (F.count(price) == 0) | ((F.count(price) == rows) & (F.min(price) == F.max(price)))
    oldest = F.min(F.struct("date_upd", "product_id"))
    return (
        snapshot.where((F.col("show_in_report") == "t") & F.col("product_id").isin(*products))
        .groupBy("station_id")
        .agg(rows.alias("count_diesel"), one_price.alias("one_price"), oldest.alias("oldest"))
        .where((F.col("count_diesel") > 1) & F.col("one_price"))
        .select("station_id", "oldest.product_id", "oldest.date_upd", "count_diesel")
    )


def off_old_diesel(snapshot: DataFrame, products: Iterable[int] = refdata.DIESEL_PRODUCTS) -> DataFrame:
    keys = diesel_duplicates(snapshot, products).select("station_id", "product_id")
    return change(keys, "off_old_diesel", "f", only_flag="t", grain="product")
