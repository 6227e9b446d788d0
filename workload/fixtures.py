"""The driver tables in the shape of the library's inputs."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.functions.prices import shown_flag
from forecourt.plans.nearest import StationTables
from forecourt.plans.visibility import PriceTables

AS_OF = date(2024, 1, 31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price table from lineitem, one row per (station, product, source)."""
    raw = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS station_id",
        """CAST(CASE l_partkey % 12 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 3 THEN 41 WHEN 4 THEN 173
             WHEN 5 THEN 174 WHEN 6 THEN 176 WHEN 7 THEN 177 WHEN 8 THEN 181 WHEN 9 THEN 182 WHEN 10 THEN 178
             ELSE 999 END AS BIGINT) AS product_id""",
        """CASE (l_orderkey + CASE WHEN l_linenumber <= 3 THEN 0 ELSE 5 END) % 10
             WHEN 0 THEN 'api_ppr' WHEN 1 THEN 'api_yandex_fuel' WHEN 2 THEN 'api_rncard' WHEN 3 THEN 'api_azsgo'
             WHEN 4 THEN 'manual_app' WHEN 5 THEN 'api_gpn' WHEN 6 THEN 'api_benzuber' WHEN 7 THEN 'api_azsopti'
             WHEN 8 THEN 'manual_phone' ELSE 'api_yandex_other' END AS source""",
        """CASE WHEN l_partkey % 12 = 10 THEN CAST(9 + l_suppkey % 5 AS DOUBLE)
             WHEN l_suppkey % 20 = 0 THEN 5D
             ELSE CAST(520 + (l_suppkey % 4) * 60 AS DOUBLE) / 10 END AS price""",
        """CASE WHEN l_orderkey % 4 = 0 THEN 'f' WHEN l_linenumber <= 3 AND l_partkey % 5 <> 0 THEN 't'
             WHEN l_linenumber > 3 AND l_orderkey % 11 = 0 THEN 't' ELSE 'f' END AS show_in_report""",
        "CASE WHEN l_quantity <= 35 THEN 0 ELSE CAST(l_partkey % 28 AS INT) END AS age_days",
        "l_linenumber AS ln",
        "l_partkey AS pk",
    )
    # the row with the lowest (price, show_in_report, ln, pk, age_days), packed into one number
    # so that the aggregation hashes instead of sorting; part keys have 40 bits here
    packed = raw.selectExpr(
        "station_id",
        "product_id",
        "source",
        """(shiftleft(CAST(price * 10 AS BIGINT), 45) | shiftleft(CAST(show_in_report = 't' AS BIGINT), 44)
            | shiftleft(CAST(ln AS BIGINT), 41) | shiftleft(pk, 1) | CAST(age_days > 0 AS BIGINT)) AS packed""",
    )
    lowest = packed.groupBy("station_id", "product_id", "source").agg(F.min("packed").alias("p"))
    return lowest.selectExpr(
        "station_id",
        "product_id",
        "source",
        "CAST(shiftright(p, 45) AS DOUBLE) / 10 AS price",
        "CASE WHEN (shiftright(p, 44) & 1L) = 1 THEN 't' ELSE 'f' END AS show_in_report",
        """CAST(date_sub(DATE '2024-01-31', CASE WHEN (p & 1L) = 1
             THEN CAST((shiftright(p, 1) & 1099511627775L) % 28 AS INT) ELSE 0 END) AS TIMESTAMP)
             + INTERVAL 10 HOURS AS updated_at""",
        "0L AS updated_by_id",
    )


def full_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price table from lineitem with every limit, every ranked source and one without a rank, several rows of a key,
    rows older than all limits of age, and missing prices and flags."""
    products = ", ".join(str(p) for p in (*sorted(refdata.PRICE_LIMITS), 999, 1000))
    sources = ", ".join(f"'{s}'" for s in (*sorted(refdata.SOURCE_RANK), "api_azsgo", "api_unranked"))
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS station_id",
        f"CAST(array({products})[CAST((l_orderkey * 3 + l_linenumber div 2) % 25 AS INT)] AS BIGINT) AS product_id",
        f"array({sources})[CAST((l_orderkey + CASE WHEN l_linenumber <= 4 THEN 0 ELSE 5 END) % 19 AS INT)] AS source",
        """CASE WHEN l_suppkey % 23 = 0 THEN NULL WHEN l_orderkey % 2 = 0 THEN 60D
             ELSE CAST(200 + l_suppkey * 7 % 100 * 10 AS DOUBLE) / 10 END AS price""",
        """CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_orderkey % 3 = 0 THEN 'f' WHEN l_partkey % 4 <> 0 THEN 't'
             ELSE 'f' END AS show_in_report""",
        """CAST(date_sub(DATE '2024-01-31', CASE WHEN l_quantity <= 25 THEN 0 ELSE CAST(l_partkey % 70 AS INT) END) AS TIMESTAMP)
             + INTERVAL 10 HOURS AS updated_at""",
        "0L AS updated_by_id",
    )


def full_tables(spark: SparkSession, sf_dir: str) -> PriceTables:
    return replace(price_tables(spark, sf_dir), prices=full_prices(spark, sf_dir))


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule input over all stations."""
    return snapshot_of(prices(spark, sf_dir))


def snapshot_of(prices: DataFrame) -> DataFrame:
    return prices.select(
        "station_id",
        "product_id",
        "price",
        "source",
        shown_flag(F.col("show_in_report")).alias("show_in_report"),
        F.to_date("updated_at").alias("date_upd"),
    )


def price_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "CAST(o_orderkey % 100 AS INT) AS region_id", "o_custkey AS parcon_id"
    )


def customer_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where("o_orderkey % 5 = 0")
        .selectExpr(
            "o_orderkey AS id",
            "CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey ELSE o_orderkey + 2 END AS station_id",
            "o_custkey AS customer_id",
        )
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        """CASE c_custkey % 5 WHEN 0 THEN 'client' WHEN 1 THEN 'demo' WHEN 2 THEN 'trial' WHEN 3 THEN 'lead'
             ELSE 'archived' END AS status""",
    )


def competitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where("o_orderkey % 5 = 0")
        .selectExpr(
            "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey + 1 END AS station_id",
            "o_orderkey AS customer_station_id",
        )
    )


def price_tables(spark: SparkSession, sf_dir: str) -> PriceTables:
    return PriceTables(
        prices=prices(spark, sf_dir),
        stations=price_stations(spark, sf_dir),
        customer_stations=customer_stations(spark, sf_dir),
        customers=customers(spark, sf_dir),
        competitors=competitors(spark, sf_dir),
    )


def gas_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS gs_id",
        "c_mktsegment AS owner_type",
        """CASE c_custkey % 9 WHEN 0 THEN 'АЗС' WHEN 1 THEN 'АЗК' WHEN 2 THEN 'АГЗС' WHEN 3 THEN 'АГНКС'
             WHEN 4 THEN 'МАГЗС' WHEN 5 THEN 'КриоАЗС' WHEN 6 THEN 'МАЗК' WHEN 7 THEN 'МАЗС'
             ELSE 'Нефтебаза' END AS type""",
        """CASE c_custkey % 8 WHEN 0 THEN 'Реконструкция' WHEN 1 THEN 'Ведомственная' WHEN 2 THEN 'Закрыта'
             ELSE 'Действующая' END AS status_gs""",
        "CAST(c_custkey AS STRING) AS owner_number",
        "c_nationkey AS brand_id",
        "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(c_custkey % 25 AS INT) END AS affiliation_id",
        "c_nationkey % 5 AS region_id",
    )


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_custkey * 7919 % 30000 AS a", "c_custkey * 104729 % 160000 AS b"
    )
    return numbers.selectExpr(
        "id AS gs_id",
        "CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('M-', CAST(id % 12 AS STRING)) END AS road_number",
        "CASE WHEN id % 4 = 0 THEN NULL ELSE CAST(id % 900 AS DOUBLE) END AS road_km",
        "CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Нет_данных' WHEN 2 THEN '' ELSE 'Левая' END AS side",
        "CASE WHEN id % 3 = 0 THEN NULL ELSE concat('City', CAST(id % 40 AS STRING)) END AS city",
        "CASE WHEN id % 7 = 0 THEN CAST(NULL AS STRING) ELSE '' END AS locality",
        "CASE WHEN id % 2 = 0 THEN '' ELSE 'Main st' END AS street",
        "CASE WHEN id % 3 = 1 THEN NULL ELSE CAST(id % 50 AS STRING) END AS building",
        """CASE WHEN id % 97 = 0 THEN NULL WHEN id % 89 = 0 THEN '' ELSE
             concat(CAST(41 + a div 1000 AS STRING), '.', lpad(CAST(a % 1000 AS STRING), 3, '0'), ', ',
                    CAST(20 + b div 1000 AS STRING), '.', lpad(CAST(b % 1000 AS STRING), 3, '0')) END AS gps_var""",
    )


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr("n_nationkey AS id", "n_name AS name")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").selectExpr("r_regionkey AS id", "r_name AS region_name")


def station_tables(spark: SparkSession, sf_dir: str) -> StationTables:
    return StationTables(
        stations=gas_stations(spark, sf_dir),
        addresses=addresses(spark, sf_dir),
        brands=brands(spark, sf_dir),
        regions=regions(spark, sf_dir),
        price_stations=price_stations(spark, sf_dir),
        prices=prices(spark, sf_dir),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON record per customer: some empty, some paths missing, phones a JSON null."""
    return table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS itn",
        """CASE WHEN c_custkey % 11 = 0 THEN '[]' ELSE concat('[{"value":"', c_name, '","data":{"type":"',
             CASE WHEN c_custkey % 3 = 0 THEN 'INDIVIDUAL' ELSE 'LEGAL' END, '",',
             CASE WHEN c_custkey % 3 = 0 THEN concat('"fio":{"surname":"S', CAST(c_custkey AS STRING), '","name":"N"',
                    CASE WHEN c_custkey % 2 = 0 THEN ',"patronymic":"P"' ELSE '' END, '}')
                  ELSE concat('"management":{"name":"Dir ', CAST(c_custkey AS STRING), '"}') END,
             ',"address":{"unrestricted_value":"', c_mktsegment, '"},"phones":null,"state":{"status":"',
             CASE c_custkey % 5 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'LIQUIDATING' WHEN 2 THEN 'LIQUIDATED'
                  WHEN 3 THEN 'BANKRUPT' ELSE 'REORGANIZING' END, '"',
             CASE WHEN c_custkey % 7 = 0 THEN ''
                  ELSE concat(',"actuality_date":', CAST(1600000000000 + c_custkey * 86400123 AS STRING)) END,
             '},"okved":"', CAST(c_custkey % 99 AS STRING), '"}}]') END AS payload""",
    )


def company_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids to look up, many times over; some are on no record."""
    return table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_custkey + o_orderkey % 3 * 1000 AS STRING) AS itn"
    )


def registry_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of three loads: the second replaces every record by a smaller text, with lists of contacts in all
    shapes and some texts that are no JSON; the third brings some of the first ones back."""
    first = registry(spark, sf_dir).selectExpr("itn", "payload", "1L AS loaded")
    second = table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS itn",
        """CASE WHEN c_custkey % 13 = 0 THEN '[{"broken"' ELSE concat('[{"data":{"phones":',
             CASE c_custkey % 6 WHEN 0 THEN 'null' WHEN 1 THEN '[]' WHEN 2 THEN '["+7 1", "+7 2"]'
               WHEN 3 THEN '[{"value":"+7 3","kind":"work"},{"value":null},null,{"value":"+7 4"}]'
               WHEN 4 THEN '"+7 5"' ELSE '[7]' END,
             CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN ',"emails":[{"value":"a@b.c"},"d@e.f"]'
               ELSE ',"emails":["only@one.x"]' END,
             ',"okved":', CASE c_custkey % 2 WHEN 0 THEN '["1.1","1.2"]' ELSE '"2"' END,
             ',"kpp":', CASE c_custkey % 3 WHEN 0 THEN '["k1"]' WHEN 1 THEN '770101' ELSE 'null' END,
             '},"value":"later"}]') END AS payload""",
        "2L AS loaded",
    )
    return first.union(second).union(first.where("itn % 10 = 0").selectExpr("itn", "payload", "3L"))


def point_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a coordinate file, a part of them broken in one of several ways."""
    return table(spark, sf_dir, "customer").selectExpr(
        """CASE c_custkey % 20 WHEN 0 THEN concat('x', c_custkey, ';1.5;2.5') WHEN 1 THEN concat(c_custkey, ';1.5')
             WHEN 2 THEN concat(c_custkey, ';1.5;2.5;3.5') WHEN 3 THEN concat(c_custkey, ';north;2.5')
             WHEN 4 THEN concat(c_custkey, ';;2.5') WHEN 5 THEN concat(c_custkey, ';NaN;2.5')
             WHEN 6 THEN concat(c_custkey, ';91.5;2.5') WHEN 7 THEN concat(c_custkey, ';1.5;-181.25')
             ELSE concat(c_custkey, ';', c_custkey % 90, '.25;-', c_custkey % 180, '.5') END AS value"""
    )


def broken_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses, a part of them with coordinates that are no numbers."""
    broken = "CASE WHEN gs_id % 7 = 0 THEN 'north, 30.5' WHEN gs_id % 11 = 0 THEN '55.5 30.5' WHEN gs_id % 13 = 0 THEN '50.5, Infinity' ELSE gps_var END"
    return addresses(spark, sf_dir).selectExpr("*", f"{broken} AS gps_new").drop("gps_var").withColumnRenamed("gps_new", "gps_var")
