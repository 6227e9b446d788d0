"""From station and price tables to the competitor table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from forecourt.operators import competitors, knn, stations
from forecourt.session import materialise, require_utc, run_folder


@dataclass(frozen=True)
class StationTables:
    stations: DataFrame  # gs_id, owner_type, type, owner_number, status_gs, brand_id, affiliation_id, region_id
    addresses: DataFrame  # gs_id, road_number, road_km, side, city, locality, street, building, gps_var
    brands: DataFrame  # id, name
    regions: DataFrame  # id, region_name
    price_stations: DataFrame  # id, parcon_id
    prices: DataFrame  # station_id, source, updated_at


def enriched_pairs(tables: StationTables, k: int) -> DataFrame:
    """Neighbour pairs with both ends' data. The directory is joined twice, so it is written
    once; Spark then broadcasts it if it is small.

    What is written on the way is kept until ``session.remove_runs``, or goes to the caller's ``run_folder``.
    """
    with run_folder(tables.stations.sparkSession, keep=True):
        points = stations.station_points(tables.stations, tables.addresses)
        directory = materialise(
            stations.station_directory(tables.stations, tables.addresses, tables.brands, tables.regions), "directory"
        )
        return competitors.competitor_enrich(knn.knn_pairs(points, k), directory)


def nearest_competitors(tables: StationTables, k: int, as_of: date) -> DataFrame:
    require_utc(tables.prices.sparkSession)
    enriched = enriched_pairs(tables, k)
    sources = competitors.competitor_price_sources(tables.price_stations, tables.prices, as_of)
    return competitors.nearest_competitors(enriched, competitors.best_price_class(sources))
