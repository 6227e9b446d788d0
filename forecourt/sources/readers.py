"""Inputs: database tables, id lists, coordinate files and registry dumps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F

POINT_SCHEMA = "id BIGINT, lat DOUBLE, lon DOUBLE"


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options. A table can be read in ranges of a numeric column, in parallel; a
    query that needs ranges is given as the table ``(query) AS t``, as Spark requires."""
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    options = {"url": url, "fetchsize": "10000", **(properties or {})}
    if partition_column is None:
        options.update({"query": query} if query is not None else {"dbtable": table})
        return options
    if bounds is None or partitions is None:
        raise ValueError("a partitioned read needs bounds and a number of partitions")
    options["dbtable"] = table if table is not None else f"({query}) AS t"
    options.update(
        partitionColumn=partition_column,
        lowerBound=str(bounds[0]),
        upperBound=str(bounds[1]),
        numPartitions=str(partitions),
    )
    return options


def jdbc_reader(spark: SparkSession, **kwargs) -> DataFrameReader:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(itn) one id per line; only the line break is cut off."""
    return spark.read.text(path).select(F.col("value").alias("itn"))


def scan_points(spark: SparkSession, path: str) -> DataFrame:
    """(id, lat, lon, broken) of every line ``id;lat;lon`` of a file without a header.

    ``broken`` holds a line that is no such record (another number of fields, an id or coordinate that is missing,
    no number, not finite or off the globe); its other columns are NULL. It is NULL for the good ones. Blank lines count as broken.
    """
    options = {"sep": ";", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    lines = spark.read.text(path)
    record = lines.select("value", F.from_csv("value", F.lit(f"{POINT_SCHEMA}, broken STRING"), options).alias("r"))
    on_globe = F.abs("r.lat") <= 90, F.abs("r.lon") <= 180  # NaN is greater than any number
    good = F.col("r.broken").isNull() & F.col("r.id").isNotNull() & F.coalesce(on_globe[0] & on_globe[1], F.lit(False))
    return record.select(
        *(F.when(good, F.col(f"r.{c}")).alias(c) for c in ("id", "lat", "lon")), F.when(~good, F.col("value")).alias("broken")
    )


def read_points(spark: SparkSession, path: str, counts: Observation | None = None) -> DataFrame:
    """(id, lat, lon) of the good lines of a file, see ``scan_points``.

    The pass that reads them also fills ``counts``: lines, broken.
    """
    found = scan_points(spark, path)
    if counts is not None:
        found = found.observe(counts, F.count(F.lit(1)).alias("lines"), F.count("broken").alias("broken"))
    return found.where(F.col("broken").isNull()).select("id", "lat", "lon")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """(itn, payload, loaded) from JSON lines; the payload stays text until it is needed.

    ``loaded`` is the number of the load that brought the record, NULL where a line has none.
    """
    return spark.read.schema("itn STRING, payload STRING, loaded BIGINT").json(path)
