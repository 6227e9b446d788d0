"""Rules that give a dark station one source to show."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.functions.prices import best_first, day, passes_closed, picked_rank, source_rank, with_limits
from forecourt.operators.changes import change
from forecourt.operators.summary import SOURCE_KEY, product_summary, source_quality


def source_candidates(
    snapshot: DataFrame,
    as_of: date,
    ranks: Mapping[str, int] = refdata.SOURCE_RANK,
    limits: Mapping[int, tuple[float, float]] = refdata.PRICE_LIMITS,
    max_error_share: float = refdata.MAX_ERROR_SHARE,
    strict_rank: bool = False,
) -> DataFrame:
    """Every source a dark station could show, with its verdict, rank and number of rivals.

    The window runs over one row per source of a station, not over price rows.
    """
    station = Window.partitionBy("station_id")
    offered = (F.col("count_fuel") > 0) & F.col("source").isNotNull()
    return (
        source_quality(snapshot, as_of, limits, max_error_share)
        .withColumn("station_shown", F.sum("shown").over(station))
        .withColumn("station_fresh", F.sum("fresh").over(station))
        .withColumn("amount", F.count_if(offered).over(station))
        .where((F.col("station_shown") == 0) & (F.col("station_fresh") > 0) & offered)
        .select(
            "station_id",
            "source",
            day(as_of).alias("date_upd"),
            "count_fuel",
            "total",
            "bad",
            "check",
            "count_err",
            "amount",
            source_rank(F.col("source"), ranks, strict_rank).alias("rate"),
        )
    )


def pick_sources(
    quality: DataFrame, as_of: date, ranks: Mapping[str, int] = refdata.SOURCE_RANK, strict_rank: bool = False
) -> DataFrame:
    """The best-ranked source of every dark station, from ``source_quality``.

    It is picked before its prices are judged: a best source with too many errors leaves the
    station dark. Rows without a source count as shown, but cannot be picked. ``strict_rank``
    fails on a dark station that is offered a source without a rank.
    """
    rate = source_rank(F.col("source"), ranks)
    offered = (F.col("count_fuel") > 0) & F.col("source").isNotNull()
    best = F.struct(*best_first(rate, F.col("source")), "count_fuel", "check", "count_err")
    return (
        quality.groupBy("station_id")
        .agg(
            F.sum("shown").alias("shown"),
            F.sum("fresh").alias("fresh"),
            F.count_if(offered).alias("amount"),
            F.min(F.when(offered, best)).alias("best"),
            F.min(F.when(offered & rate.isNull(), F.col("source"))).alias("unranked"),
        )
        .where((F.col("shown") == 0) & (F.col("fresh") > 0) & F.col("best").isNotNull())
        .select(
            "station_id",
            "best.source",
            day(as_of).alias("date_upd"),
            "best.count_fuel",
            "best.check",
            "best.count_err",
            "amount",
            picked_rank(F.col("best.rate"), F.col("unranked"), strict_rank).alias("rate"),
        )
    )


def score_new_sources(
    snapshot: DataFrame,
    as_of: date,
    ranks: Mapping[str, int] = refdata.SOURCE_RANK,
    limits: Mapping[int, tuple[float, float]] = refdata.PRICE_LIMITS,
    max_error_share: float = refdata.MAX_ERROR_SHARE,
    strict_rank: bool = False,
) -> DataFrame:
    """``pick_sources`` of a snapshot: three nested aggregations, no join with the snapshot."""
    return pick_sources(source_quality(snapshot, as_of, limits, max_error_share), as_of, ranks, strict_rank)


def on_new(scored: DataFrame, as_of: date, rule: str, sources: Iterable[str], days: int) -> DataFrame:
    """Show a source without errors: its rows of the last ``days`` and of the day itself."""
    keys = scored.where((F.col("check") == "OK") & F.col("count_err").isNull() & F.col("source").isin(*sources))
    return change(keys.select(*SOURCE_KEY), rule, "t", day(as_of, -days), day(as_of, 1), grain="source")


def on_new_trusted(
    scored: DataFrame, as_of: date, sources: Iterable[str] = refdata.TRUSTED_SOURCES, days: int = 0
) -> DataFrame:
    return on_new(scored, as_of, "on_new_trusted", sources, days)


def on_new_untrusted(
    scored: DataFrame,
    as_of: date,
    sources: Iterable[str] = refdata.UNTRUSTED_SOURCES,
    days: int = refdata.UNTRUSTED_WINDOW_DAYS,
) -> DataFrame:
    return on_new(scored, as_of, "on_new_untrusted", sources, days)


def partial_keys(scored: DataFrame, as_of: date, rule: str, sources: Iterable[str], days: int) -> DataFrame:
    """Best sources with a few errors, as input of ``show_within_limits``."""
    keys = scored.where(F.col("count_err").isNotNull() & F.col("source").isin(*sources))
    return chosen_sources(keys, rule, day(as_of, -days))


def chosen_sources(keys: DataFrame, rule: str, from_date: Column, hidden_only: bool = False) -> DataFrame:
    return keys.select(
        *SOURCE_KEY,
        F.lit(rule).alias("rule"),
        from_date.alias("from_date"),
        F.lit(hidden_only).alias("hidden_only"),
    )


def show_within_limits(
    chosen: DataFrame,
    products: DataFrame,
    as_of: date,
    limits: Mapping[int, tuple[float, float]] = refdata.PRICE_LIMITS,
) -> DataFrame:
    """Show the products of the chosen sources that pass the closed interval.

    ``products`` is a ``product_summary``. With ``hidden_only`` a product needs a hidden row
    of the day.
    """
    joined = products.select(*SOURCE_KEY, "product_id", "price", "hidden_today").join(chosen, SOURCE_KEY)
    keys = with_limits(joined.where(~F.col("hidden_only") | (F.col("hidden_today") > 0)), limits).where(
        passes_closed(F.col("price"), F.col("lo"), F.col("hi"))
    )
    return change(keys, F.col("rule"), "t", F.col("from_date"), day(as_of, 1), grain="source_product")


def on_partial_trusted(
    scored: DataFrame,
    snapshot: DataFrame,
    as_of: date,
    sources: Iterable[str] = refdata.TRUSTED_SOURCES,
    days: int = 0,
    limits: Mapping[int, tuple[float, float]] = refdata.PRICE_LIMITS,
    products: DataFrame | None = None,
) -> DataFrame:
    """Show the products within limits of a trusted source with a few errors.

    A ready ``product_summary`` of the snapshot saves reading it once more.
    """
    sources = tuple(sources)
    chosen = partial_keys(scored, as_of, "on_partial_trusted", sources, days)
    products = products or product_summary(snapshot.where(F.col("source").isin(*sources)), as_of)
    return show_within_limits(chosen, products, as_of, limits)


def on_partial_untrusted(
    scored: DataFrame,
    snapshot: DataFrame,
    as_of: date,
    sources: Iterable[str] = refdata.UNTRUSTED_SOURCES,
    days: int = refdata.UNTRUSTED_WINDOW_DAYS,
    limits: Mapping[int, tuple[float, float]] = refdata.PRICE_LIMITS,
    products: DataFrame | None = None,
) -> DataFrame:
    """Show the products within limits of an untrusted source with a few errors.

    A ready ``product_summary`` of the snapshot saves reading it once more.
    """
    sources = tuple(sources)
    chosen = partial_keys(scored, as_of, "on_partial_untrusted", sources, days)
    products = products or product_summary(snapshot.where(F.col("source").isin(*sources)), as_of)
    return show_within_limits(chosen, products, as_of, limits)
