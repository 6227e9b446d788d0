"""Text columns of the station directory."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.functions.prices import lookup


def gps_part(gps: Column, which: int) -> Column:
    """Text before the first (1) or after the last (-1) comma, trimmed."""
    return F.trim(F.substring_index(gps, ",", which))


def is_finite(value: Column) -> Column:
    """False or NULL for NULL, NaN (above all numbers in Spark) and the infinities."""
    return F.abs(value) < float("inf")


def number_or_null(text: Column) -> Column:
    """Finite double, or NULL for anything else."""
    value = text.try_cast("double")
    return F.when(is_finite(value), value)


def integer_or_null(text: Column) -> Column:
    return text.try_cast("bigint")


def part(text: Column, suffix: str = ", ", skip: tuple[str, ...] = ("",)) -> Column:
    """``text`` with a separator behind it, or '' where it is NULL or a skipped value."""
    return F.when(text.isNull() | text.isin(*skip), "").otherwise(F.concat(text, F.lit(suffix)))


def address_text(
    road_number: Column, road_km: Column, side: Column, city: Column, locality: Column, street: Column, building: Column
) -> Column:
    """One line of address from its optional parts."""
    km = F.round(road_km.cast("double"), 0).cast("bigint").cast("string")
    return F.trim(
        F.concat(
            part(road_number),
            part(km, refdata.KM_SUFFIX),
            part(side, skip=("", refdata.NO_SIDE)),
            part(city),
            part(locality),
            part(street),
            part(building, ""),
        )
    )


def drop_last_comma(text: Column) -> Column:
    """Without one comma at the very end."""
    return F.regexp_replace(text, r",\z", "")


def station_class(kind: Column, classes: Mapping[str, int] = refdata.STATION_CLASS) -> Column:
    return F.coalesce(lookup(kind, classes), F.lit(0))
