"""Rules for stations that already show exactly one source."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.functions.prices import day, equivalence_group, passes_closed, with_limits
from forecourt.operators.changes import change
from forecourt.operators.summary import PRODUCT_KEY, SOURCE_KEY, source_summary


# prices are equal to the kopeck
PRICE_KIND = "decimal(20, 2)"


def only_source(per_source: DataFrame) -> DataFrame:
    """(station, source) of the only source shown, where it also has new hidden prices.
    From ``source_summary``."""
    is_shown = (F.col("shown") > 0) & F.col("source").isNotNull()
    return (
        per_source.groupBy("station_id")
        .agg(
            F.count_if(is_shown).alias("count_source"),
            F.min(F.when(is_shown, F.struct("source", "shown", "fresh"))).alias("only"),
        )
        .where((F.col("count_source") == 1) & (F.col("only.fresh") > 0))
        .select(
            "station_id",
            "only.source",
            F.col("only.shown").alias("count_fuel_true"),
            F.col("only.fresh").alias("count_fuel_false"),
        )
    )


def in_report_new_products(snapshot: DataFrame, as_of: date) -> DataFrame:
    return only_source(source_summary(snapshot, as_of))


def in_report_products(
    snapshot: DataFrame,
    as_of: date,
    sources: Iterable[str] = refdata.TRUSTED_SOURCES,
    window_days: int = refdata.IN_REPORT_WINDOW_DAYS,
    price_days: int = refdata.EQUIVALENT_PRICE_DAYS,
) -> DataFrame:
    """What both rules need to know of every (station, source, product), in one aggregation."""
    shown, hidden = F.col("show_in_report") == "t", F.col("show_in_report") == "f"
    updated, today = F.col("date_upd"), F.col("date_upd") == day(as_of)
    trusted = F.col("source").isin(*sources)
    in_window = F.when(trusted, today).otherwise(updated > day(as_of, -window_days - 1))
    in_price_window = F.when(trusted, today).otherwise(updated > day(as_of, -price_days))
    price = F.col("price")
    return snapshot.groupBy(*PRODUCT_KEY).agg(
        F.min("price").alias("price"),
        F.count_if(hidden & in_window).alias("hidden_new"),
        F.min(F.when(in_price_window, price)).alias("new_price"),
        F.min(F.when(shown & today, price)).alias("shown_price"),
        F.count_if(shown & (updated < day(as_of))).alias("shown_stale"),
        F.count_if(shown).alias("shown"),
        F.count_if(hidden & today & (price > 0)).alias("fresh"),
    )


def equivalent_product_dup(candidates: DataFrame, shown: DataFrame, groups=refdata.EQUIVALENT_PRODUCTS) -> DataFrame:
    """Candidates whose fuel is already shown under another product at the same price.

    ``candidates`` has (station, source, product, new_price), ``shown`` the same key with
    shown_price. Prices are equal when they are to the hundredth.
    """
    return _equivalents(candidates, shown, groups, "left_semi")


def _equivalents(candidates: DataFrame, shown: DataFrame, groups, how: str) -> DataFrame:
    twins = shown.where(F.col("shown_price").isNotNull()).select(
        F.col("station_id").alias("twin_station"),
        F.col("source").alias("twin_source"),
        equivalence_group(F.col("product_id"), groups).alias("twin_group"),
        F.col("shown_price").alias("twin_price"),
        F.col("product_id").alias("twin_product"),
    )
    same = (
        (F.col("station_id") == F.col("twin_station"))
        & (F.col("source") == F.col("twin_source"))
        & (F.col("fuel") == F.col("twin_group"))
        & (F.col("new_price").try_cast(PRICE_KIND) == F.col("twin_price").try_cast(PRICE_KIND))
        & (F.col("product_id") != F.col("twin_product"))
    )
    tagged = candidates.withColumn("fuel", equivalence_group(F.col("product_id"), groups))
    return tagged.join(twins.where(F.col("twin_group").isNotNull()), same, how).drop("fuel")


def equivalence_input(
    snapshot: DataFrame,
    as_of: date,
    sources: Iterable[str] = refdata.TRUSTED_SOURCES,
    window_days: int = refdata.IN_REPORT_WINDOW_DAYS,
    price_days: int = refdata.EQUIVALENT_PRICE_DAYS,
) -> tuple[DataFrame, DataFrame]:
    """Hidden new products of all stations, and the products shown on the day."""
    products = in_report_products(snapshot, as_of, tuple(sources), window_days, price_days)
    return (
        products.where(F.col("hidden_new") > 0).select(*PRODUCT_KEY, "new_price"),
        products.where(F.col("shown_price").isNotNull()).select(*PRODUCT_KEY, "shown_price"),
    )


def base_sources(products: DataFrame) -> DataFrame:
    """``only_source`` from ``in_report_products``."""
    per_source = products.groupBy(*SOURCE_KEY).agg(F.sum("shown").alias("shown"), F.sum("fresh").alias("fresh"))
    return only_source(per_source).select(*SOURCE_KEY)


def show_new_products(
    products: DataFrame,
    base: DataFrame,
    as_of: date,
    sources: Iterable[str] = refdata.TRUSTED_SOURCES,
    window_days: int = refdata.IN_REPORT_WINDOW_DAYS,
    limits: Mapping[int, tuple[float, float]] = refdata.PRICE_LIMITS,
    groups=refdata.EQUIVALENT_PRODUCTS,
) -> DataFrame:
    """Show new products of the only source, unless the same fuel is shown at that price."""
    concerned = products.where(F.col("hidden_new") > 0).join(base, SOURCE_KEY, "left_semi")
    valid = (
        with_limits(concerned, limits)
        .where(passes_closed(F.col("price"), F.col("lo"), F.col("hi")))
        .select(*PRODUCT_KEY, "new_price")
    )
    keys = _equivalents(valid, products, groups, "left_anti")
    start = F.when(F.col("source").isin(*sources), day(as_of)).otherwise(day(as_of, -window_days))
    return change(keys, "on_in_report_new", "t", start, day(as_of, 1), grain="source_product")


def hide_stale_products(
    products: DataFrame, base: DataFrame, skip_sources: Iterable[str] = refdata.UNTRUSTED_SOURCES
) -> DataFrame:
    """Hide the older products of the only source once it has new prices."""
    stale = products.where((F.col("shown_stale") > 0) & ~F.col("source").isin(*skip_sources)).select(*PRODUCT_KEY)
    return change(stale.join(base, SOURCE_KEY, "left_semi"), "off_stale_in_report", "f", grain="source_product")


def on_in_report_new(
    snapshot: DataFrame,
    as_of: date,
    sources: Iterable[str] = refdata.TRUSTED_SOURCES,
    window_days: int = refdata.IN_REPORT_WINDOW_DAYS,
    price_days: int = refdata.EQUIVALENT_PRICE_DAYS,
    limits: Mapping[int, tuple[float, float]] = refdata.PRICE_LIMITS,
    groups=refdata.EQUIVALENT_PRODUCTS,
) -> DataFrame:
    sources = tuple(sources)
    products = in_report_products(snapshot, as_of, sources, window_days, price_days)
    return show_new_products(products, base_sources(products), as_of, sources, window_days, limits, groups)


def off_stale_in_report(
    snapshot: DataFrame, as_of: date, skip_sources: Iterable[str] = refdata.UNTRUSTED_SOURCES
) -> DataFrame:
    products = in_report_products(snapshot, as_of)
    return hide_stale_products(products, base_sources(products), skip_sources)
