"""Rules that put one source in the place of another."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.functions.prices import best_first, day, picked_rank, source_rank
from forecourt.operators.activation import chosen_sources, show_within_limits
from forecourt.operators.changes import change
from forecourt.operators.summary import limit_check, product_summary, source_summary


def pick_replacements(
    per_source: DataFrame,
    replaceable: Iterable[str] = refdata.REPLACEABLE_SOURCES,
    replacing: Iterable[str] = refdata.REPLACING_SOURCES,
    ranks: Mapping[str, int] = refdata.SOURCE_RANK,
    strict_rank: bool = False,
) -> DataFrame:
    """(station, old source, new source): the only source shown is a replaceable one, and a
    reliable one has new hidden prices. From ``source_summary`` or ``source_quality``."""
    replaceable, replacing = tuple(replaceable), tuple(replacing)
    source = F.col("source")
    is_shown = (F.col("shown") > 0) & source.isNotNull()
    offered = source.isin(*replacing) & (F.col("fresh") > 0)
    rate = source_rank(source, ranks)
    return (
        per_source.groupBy("station_id")
        .agg(
            F.count_if(is_shown).alias("count_source"),
            F.min(F.when(is_shown & source.isin(*replaceable), source)).alias("old_source"),
            F.min(F.when(offered, F.struct(*best_first(rate, source)))).alias("best"),
            F.min(F.when(offered & rate.isNull(), source)).alias("unranked"),
        )
        .where((F.col("count_source") == 1) & F.col("old_source").isNotNull() & F.col("best").isNotNull())
        .select(
            "station_id",
            "old_source",
            F.col("best.source").alias("new_source"),
            picked_rank(F.col("best.rate"), F.col("unranked"), strict_rank).alias("rate"),
        )
    )


def source_replacement(
    snapshot: DataFrame,
    as_of: date,
    replaceable: Iterable[str] = refdata.REPLACEABLE_SOURCES,
    replacing: Iterable[str] = refdata.REPLACING_SOURCES,
    ranks: Mapping[str, int] = refdata.SOURCE_RANK,
    strict_rank: bool = False,
) -> DataFrame:
    return pick_replacements(source_summary(snapshot, as_of), replaceable, replacing, ranks, strict_rank)


def coalesce_update(own: DataFrame, other: DataFrame, key: str, column: str) -> DataFrame:
    """Overwrite ``column`` where ``other`` has a non-null value for the key."""
    newer = other.select(key, F.col(column).alias("_newer"))
    return own.join(newer, key, "left").withColumn(column, F.coalesce("_newer", column)).drop("_newer")


def off_replaced_source(replacements: DataFrame) -> DataFrame:
    """Hide the old source, whether or not a product of the new one will pass."""
    keys = replacements.select("station_id", F.col("old_source").alias("source"))
    return change(keys, "off_replaced_source", "f", grain="source")


def on_replacing_source(
    replacements: DataFrame,
    snapshot: DataFrame,
    as_of: date,
    replacing: Iterable[str] = refdata.REPLACING_SOURCES,
    limits: Mapping[int, tuple[float, float]] = refdata.PRICE_LIMITS,
    products: DataFrame | None = None,
) -> DataFrame:
    """Show the new hidden products within limits of the new source.

    A ready ``product_summary`` of the snapshot saves reading it once more.
    """
    products = products or product_summary(snapshot.where(F.col("source").isin(*replacing)), as_of)
    return show_within_limits(replacing_keys(replacements, as_of), products, as_of, limits)


def replacing_keys(replacements: DataFrame, as_of: date) -> DataFrame:
    """New sources, as input of ``show_within_limits``."""
    keys = replacements.select("station_id", F.col("new_source").alias("source"))
    return chosen_sources(keys, "on_replacing_source", day(as_of), hidden_only=True)


def pick_race(
    quality: DataFrame, shown_source: str = "api_yandex_fuel", rival: str = "api_benzuber"
) -> DataFrame:
    """Stations where the rival has at least as many new hidden rows as are shown now.

    From ``source_quality``; ``rival_bad`` counts the rival's rows, of any date, that fail the open interval.
    """
    is_rival = F.col("source") == rival
    return (
        quality.where(F.col("source").isin(shown_source, rival))
        .groupBy("station_id")
        .agg(
            F.sum(F.when(is_rival, F.col("hidden_today")).otherwise(0)).alias("rival_rows"),
            F.sum(F.when(~is_rival, F.col("shown")).otherwise(0)).alias("shown_rows"),
            F.sum(F.when(is_rival, F.col("bad")).otherwise(0)).alias("rival_bad"),
        )
        .where(
            (F.col("shown_rows") > 0) & (F.col("rival_rows") > 0) & (F.col("rival_rows") >= F.col("shown_rows"))
        )
    )


def count_race(
    snapshot: DataFrame,
    as_of: date,
    shown_source: str = "api_yandex_fuel",
    rival: str = "api_benzuber",
    limits: Mapping[int, tuple[float, float]] = refdata.PRICE_LIMITS,
) -> DataFrame:
    both = snapshot.where(F.col("source").isin(shown_source, rival))
    return pick_race(limit_check(both, as_of, limits), shown_source, rival)


def off_yandex_for_benzuber(race: DataFrame, shown_source: str = "api_yandex_fuel") -> DataFrame:
    """Hide the shown source where the rival wins without a bad price."""
    keys = race.where(F.col("rival_bad") == 0).select("station_id", F.lit(shown_source).alias("source"))
    return change(keys, "off_yandex_for_benzuber", "f", grain="source")


def on_benzuber(race: DataFrame, as_of: date, rival: str = "api_benzuber") -> DataFrame:
    """Show the day's rows of the rival at the same stations."""
    keys = race.where(F.col("rival_bad") == 0).select("station_id", F.lit(rival).alias("source"))
    return change(keys, "on_benzuber", "t", day(as_of), day(as_of, 1), grain="source")
