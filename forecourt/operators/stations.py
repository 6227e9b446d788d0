"""Station points and the flat station directory."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.functions import text


def active_stations(stations: DataFrame, statuses: Iterable[str] = refdata.ACTIVE_STATUSES) -> DataFrame:
    return stations.where(F.col("status_gs").isin(*statuses))


def located_stations(
    stations: DataFrame, addresses: DataFrame, statuses: Iterable[str] = refdata.ACTIVE_STATUSES
) -> DataFrame:
    """(gs_id, lat_text, lon_text) of active stations that have coordinates."""
    active = active_stations(stations, statuses).select("gs_id")
    parts = addresses.select(
        "gs_id",
        text.gps_part(F.col("gps_var"), 1).alias("lat_text"),
        text.gps_part(F.col("gps_var"), -1).alias("lon_text"),
    )
    return active.join(parts, "gs_id", "left").where(F.col("lat_text").isNotNull() & (F.col("lon_text") != ""))


def located_points(
    stations: DataFrame, addresses: DataFrame, statuses: Iterable[str] = refdata.ACTIVE_STATUSES
) -> DataFrame:
    """``located_stations`` with lat and lon in degrees, and whether both are finite numbers (good)."""
    lat, lon = (text.number_or_null(F.col(c)) for c in ("lat_text", "lon_text"))
    return located_stations(stations, addresses, statuses).select("*", lat.alias("lat"), lon.alias("lon")).withColumn(
        "good", F.col("lat").isNotNull() & F.col("lon").isNotNull()
    )


def station_points(
    stations: DataFrame,
    addresses: DataFrame,
    statuses: Iterable[str] = refdata.ACTIVE_STATUSES,
    counts: Observation | None = None,
) -> DataFrame:
    """(id, lat, lon) in degrees. Coordinates that are no finite numbers are left out; the pass that
    does so also fills ``counts``: located, malformed. ``malformed_points`` lists them."""
    points = located_points(stations, addresses, statuses)
    if counts is not None:
        points = points.observe(counts, F.count(F.lit(1)).alias("located"), F.count_if(~F.col("good")).alias("malformed"))
    return points.where("good").select(F.col("gs_id").alias("id"), "lat", "lon")


def malformed_points(
    stations: DataFrame, addresses: DataFrame, statuses: Iterable[str] = refdata.ACTIVE_STATUSES
) -> DataFrame:
    """Rows that ``station_points`` leaves out because a coordinate is no number."""
    return located_points(stations, addresses, statuses).where("not good").select("gs_id", "lat_text", "lon_text")


def station_directory(
    stations: DataFrame,
    addresses: DataFrame,
    brands: DataFrame,
    regions: DataFrame,
    statuses: Iterable[str] = refdata.ACTIVE_STATUSES,
) -> DataFrame:
    """One row per active station with names, class and a one-line address."""
    brand = brands.select(F.col("id").alias("brand_id"), F.col("name").alias("brand"))
    affiliation = brands.select(F.col("id").alias("affiliation_id"), F.col("name").alias("affilation"))
    region = regions.select(F.col("id").alias("region_id"), F.col("region_name").alias("region"))
    address = text.drop_last_comma(
        text.address_text(
            *(F.col(c) for c in ("road_number", "road_km", "side", "city", "locality", "street", "building"))
        )
    )
    lines = addresses.select("gs_id", address.alias("address"), F.col("gps_var").alias("gps"))
    blank_line = F.lit("")  # a station without an address row
    return (
        active_stations(stations, statuses)
        .join(brand, "brand_id", "left")
        .join(affiliation, "affiliation_id", "left")
        .join(region, "region_id", "left")
        .join(lines, "gs_id", "left")
        .select(
            F.col("gs_id").alias("id_parcon"),
            F.col("owner_type").alias("type_1"),
            F.col("type").alias("type_azs"),
            text.station_class(F.col("type")).alias("check"),
            "brand",
            "affilation",
            F.col("owner_number").alias("number"),
            F.col("status_gs").alias("status"),
            "region",
            F.coalesce("address", blank_line).alias("address"),
            "gps",
        )
    )
