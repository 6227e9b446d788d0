"""Neighbour pairs with both stations' data, and the price sources of competitors."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.functions.prices import day, source_class
from forecourt.operators.knn import DISTANCE
from forecourt.operators.skew import group_apart


def class_compatible(
    pairs: DataFrame, allowed: Iterable[tuple[int, int]] = refdata.COMPATIBLE_CLASSES
) -> DataFrame:
    """Pairs whose (client, competitor) station classes may compete."""
    client, competitor = F.col("client_check"), F.col("comp_check")
    match = F.lit(False)
    for a, b in allowed:
        match = match | ((client == a) & (competitor == b))
    return pairs.where(match)


def competitor_sequence(pairs: DataFrame) -> DataFrame:
    """Running number from 0 of a point's pairs, nearest first; k rows per point at most."""
    nearest = Window.partitionBy("point1").orderBy("rank")
    return pairs.withColumn("sequence", F.row_number().over(nearest) - 1)


def competitor_enrich(
    pairs: DataFrame, directory: DataFrame, allowed: Iterable[tuple[int, int]] = refdata.COMPATIBLE_CLASSES
) -> DataFrame:
    """Pairs with the competitor's and the client's directory row, compatible classes only."""
    competitor = directory.select(*(F.col(c).alias(f"comp_{c}") for c in directory.columns))
    client = directory.select(
        *(F.col(c).alias(f"client_{c}") for c in ("id_parcon", "brand", "region", "type_azs", "check"))
    )
    both = pairs.join(competitor, F.col("point2") == F.col("comp_id_parcon"), "left").join(
        client, F.col("point1") == F.col("client_id_parcon"), "left"
    )
    return competitor_sequence(class_compatible(both.drop("client_id_parcon"), allowed))


def competitor_price_sources(
    stations: DataFrame, prices: DataFrame, as_of: date, sources: Iterable[str] = refdata.COMPETITOR_SOURCES
) -> DataFrame:
    """Distinct (parcon_id, source, type_source) with a price of the day."""
    today = (F.col("updated_at") >= day(as_of)) & (F.col("updated_at") < day(as_of, 1))
    # distinct before the join: a station's rows of one source become one
    seen = prices.where(today & F.col("source").isin(*sources)).select("station_id", "source").distinct()
    return (
        seen.join(stations.select(F.col("id").alias("station_id"), "parcon_id"), "station_id")
        .select("parcon_id", "source")
        .distinct()
        .withColumn("type_source", source_class(F.col("source")))
    )


def best_price_class(price_sources: DataFrame) -> DataFrame:
    """Lowest source class per station and its number of sources."""
    per_class = (
        price_sources.where(F.col("parcon_id").isNotNull())
        .groupBy("parcon_id", "type_source")
        .agg(F.count("source").alias("source_count"))
    )
    best = group_apart(per_class, ["parcon_id"], F.min(F.struct("type_source", "source_count")).alias("best"))
    return best.select("parcon_id", "best.type_source", "best.source_count")


def nearest_competitors(enriched: DataFrame, best_class: DataFrame) -> DataFrame:
    """The final table: a row per client station and competitor."""
    best = best_class.select(F.col("parcon_id").alias("comp_id_parcon"), "type_source")
    return enriched.join(best, "comp_id_parcon", "left").select(
        "point1",
        F.col("client_brand").alias("brand_client"),
        F.col("client_region").alias("region_client"),
        F.col(f"`{DISTANCE}`"),
        *(
            F.col(f"comp_{c}").alias(c)
            for c in (
                "id_parcon",
                "type_1",
                "type_azs",
                "check",
                "brand",
                "affilation",
                "number",
                "status",
                "region",
                "address",
                "gps",
            )
        ),
        "type_source",
    )
