"""Column expressions about prices, flags, dates and sources."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, timedelta
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt import refdata


def lookup(key: Column, mapping: Mapping) -> Column:
    """Value of a small fixed mapping; NULL where the key is absent."""
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items())
    return F.try_element_at(F.create_map(*pairs), key)


def source_rank(source: Column, ranks: Mapping[str, int] = refdata.SOURCE_RANK, strict: bool = False) -> Column:
    """Rank of a price source; an unranked one gives NULL, or an error when ``strict``."""
    rank = lookup(source, ranks)
    if strict:
        problem = F.concat(F.lit("price source without a rank: "), F.coalesce(source, F.lit("NULL")))
        rank = F.coalesce(rank, F.raise_error(problem).cast("int"))
    return rank


def picked_rank(rank: Column, unranked: Column, strict: bool) -> Column:
    """Rank of what was picked; an error when ``strict`` and one of those offered has no rank."""
    problem = F.concat(F.lit("price source without a rank: "), unranked)
    return F.when(unranked.isNotNull(), F.raise_error(problem).cast("int")).otherwise(rank) if strict else rank


def best_first(rank: Column, source: Column) -> list[Column]:
    """Sort key for picking one source: lowest rank, unranked last, then by name."""
    return [rank.isNull().alias("unranked"), rank.alias("rate"), source.alias("source")]


def source_class(
    source: Column,
    automatic: Iterable[str] = refdata.AUTOMATIC_SOURCES,
    other: Iterable[str] = refdata.OTHER_SOURCES,
) -> Column:
    return F.when(source.isin(*automatic), 1).when(source.isin(*other), 2).otherwise(0)


def equivalence_group(product: Column, groups: Iterable[Iterable[int]] = refdata.EQUIVALENT_PRODUCTS) -> Column:
    """Smallest product of the group the product belongs to; NULL outside all groups."""
    return lookup(product, {member: min(group) for group in map(tuple, groups) for member in group})


def clean_price(price: Column) -> Column:
    """NaN sorts above every number in Spark, so a missing price has to be NULL."""
    value = price.cast("double")
    return F.when(~F.isnan(value), value)


def shown_flag(flag: Column) -> Column:
    """'t' or else 'f', for rows that no recency filter has seen."""
    return F.when(flag == "t", "t").otherwise("f")


def fails_open(price: Column, lo: Column, hi: Column) -> Column:
    """True when the price is at or outside a limit; a NULL price does not fail."""
    return F.coalesce((price <= lo) | (price >= hi), F.lit(False))


def passes_closed(price: Column, lo: Column, hi: Column) -> Column:
    """True when the price is within the limits, limits included; a NULL price does not pass."""
    return F.coalesce(price.between(lo, hi), F.lit(False))


def with_limits(
    df: DataFrame,
    limits: Mapping[int, tuple[float, float]] = refdata.PRICE_LIMITS,
    default: tuple[float, float] = refdata.DEFAULT_LIMIT,
) -> DataFrame:
    """Add ``lo`` and ``hi`` for the row's product."""
    dim = refdata.limits_frame(df.sparkSession, limits)
    if len(limits) <= refdata.BROADCAST_ROWS:
        dim = F.broadcast(dim)
    return (
        df.join(dim, "product_id", "left")
        .withColumn("lo", F.coalesce("lo", F.lit(default[0])))
        .withColumn("hi", F.coalesce("hi", F.lit(default[1])))
    )


def day(as_of: date, shift: int = 0) -> Column:
    return F.lit(as_of + timedelta(days=shift))


def recent(
    flag: Column,
    updated_at: Column,
    as_of: date,
    shown_days: int = refdata.SHOWN_DAYS,
    hidden_days: int = refdata.HIDDEN_DAYS,
) -> Column:
    """Shown rows live longer than hidden ones; both limits are strict, against midnight.

    The longer limit alone is what a scan can use. The flag is looked up, so that it is
    computed once where it is the outcome of other expressions.
    """
    limits = {"t": as_of - timedelta(days=shown_days), "f": as_of - timedelta(days=hidden_days)}
    return (updated_at > F.lit(min(limits.values()))) & (updated_at > lookup(flag, limits))
