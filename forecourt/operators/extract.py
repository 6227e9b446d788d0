"""Which price rows the rules look at."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.functions.prices import clean_price, recent
from forecourt.operators.skew import group_apart
from forecourt.session import materialise


def client_stations(
    customer_stations: DataFrame, customers: DataFrame, statuses: Iterable[str] = refdata.CUSTOMER_STATUSES
) -> DataFrame:
    """(id, station_id) of the stations of customers in one of the statuses."""
    wanted = customers.where(F.col("status").isin(*statuses)).select(F.col("id").alias("customer_id"))
    return customer_stations.join(wanted, "customer_id").select("id", "station_id")


def competitor_stations(clients: DataFrame, competitors: DataFrame) -> DataFrame:
    """Distinct station_id of the competitors named for client stations."""
    named = competitors.where(F.col("station_id").isNotNull())
    return named.join(
        clients.select(F.col("id").alias("customer_station_id")), "customer_station_id", "left_semi"
    ).select("station_id").distinct()


def protected_stations(clients: DataFrame, competitors: DataFrame) -> DataFrame:
    """Client stations and their competitors, each once."""
    named = competitors.where(F.col("station_id").isNotNull())
    rivals = named.join(
        clients.select(F.col("id").alias("customer_station_id")), "customer_station_id", "left_semi"
    ).select("station_id")
    # one distinct over the union is enough
    both = rivals.union(clients.select("station_id")).where(F.col("station_id").isNotNull())
    return group_apart(both, ["station_id"])


def exclude_stations(df: DataFrame, stations: DataFrame) -> DataFrame:
    return df.join(stations.select("station_id"), "station_id", "left_anti")


def stations_in_scope(stations: DataFrame, protected: DataFrame, max_region: int = refdata.MAX_REGION) -> DataFrame:
    """station_id of the unprotected stations in the lower regions.

    The small tables meet first, so that the price table needs one join only.
    """
    ids = stations.where(F.col("region_id") < max_region).select(F.col("id").alias("station_id"))
    return exclude_stations(ids, protected)


def in_scope(
    df: DataFrame, stations: DataFrame, customer_stations: DataFrame, customers: DataFrame, competitors: DataFrame
) -> DataFrame:
    """Rows of the stations in scope. Their ids are written out first: Spark then knows how
    many there are, and broadcasts them or splits the rows of a hot station."""
    protected = protected_stations(client_stations(customer_stations, customers), competitors)
    scope = materialise(stations_in_scope(stations, protected), "stations-in-scope")
    return df.join(scope, "station_id", "left_semi")


def recency_filter(
    prices: DataFrame, as_of: date, shown_days: int = refdata.SHOWN_DAYS, hidden_days: int = refdata.HIDDEN_DAYS
) -> DataFrame:
    return prices.where(recent(F.col("show_in_report"), F.col("updated_at"), as_of, shown_days, hidden_days))


def as_snapshot(prices: DataFrame, as_of: date) -> DataFrame:
    """Rule input: recent rows with a clean price, a 't'/'f' flag and the date.

    The filter leaves no other flag, so the column is passed on as it is and the rules'
    filters on it reach the scan.
    """
    return recency_filter(prices, as_of).select(
        "station_id",
        "product_id",
        clean_price(F.col("price")).alias("price"),
        "source",
        "show_in_report",
        F.to_date("updated_at").alias("date_upd"),
    )


def price_extract(
    prices: DataFrame,
    stations: DataFrame,
    customer_stations: DataFrame,
    customers: DataFrame,
    competitors: DataFrame,
    as_of: date,
) -> DataFrame:
    """Recent prices of the stations in scope."""
    return in_scope(as_snapshot(prices, as_of), stations, customer_stations, customers, competitors)
