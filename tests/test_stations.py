from __future__ import annotations

from datetime import datetime

from helpers import AS_OF, rows

from forecourt.operators import competitors, stations

STATION = (
    "gs_id BIGINT, owner_type STRING, type STRING, owner_number STRING, status_gs STRING, brand_id INT, "
    "affiliation_id INT, region_id INT"
)
ADDRESS = (
    "gs_id BIGINT, road_number STRING, road_km DOUBLE, side STRING, city STRING, locality STRING, street STRING, "
    "building STRING, gps_var STRING"
)


def stations_and_addresses(spark, gps):
    made = [(i, "o", "АЗС", str(i), "Действующая", 1, None, 1) for i in gps]
    lines = [(i, None, None, None, None, None, None, None, g) for i, g in gps.items()]
    return spark.createDataFrame(made, STATION), spark.createDataFrame(lines, ADDRESS)


def test_points_and_malformed_ones(spark):
    gps = {1: "55.1, 37.2", 2: "55.1", 3: "", 4: None, 5: "a,b", 6: ",37.2", 7: "55.1,", 8: "nan,1", 9: "1,inf"}
    tables = stations_and_addresses(spark, gps)
    assert rows(stations.station_points(*tables)) == [(1, 55.1, 37.2), (2, 55.1, 55.1)]
    assert [r[0] for r in rows(stations.malformed_points(*tables))] == [5, 6, 8, 9]


def test_directory_keeps_stations_without_matches(spark):
    made = spark.createDataFrame(
        [
            (1, "o", "АГЗС", "n1", "Действующая", 1, 2, 1),
            (2, "o", "x", None, "Реконструкция", 9, None, None),
            (3, "o", "АЗС", "n3", "Закрыта", 1, 1, 1),
        ],
        STATION,
    )
    lines = spark.createDataFrame([(1, "M-1", 5.0, "", "City", None, "", None, "1,2")], ADDRESS)
    brands = spark.createDataFrame([(1, "B1"), (2, "B2")], "id INT, name STRING")
    regions = spark.createDataFrame([(1, "R1")], "id INT, region_name STRING")
    got = stations.station_directory(made, lines, brands, regions)
    assert rows(got) == [
        (1, "o", "АГЗС", 2, "B1", "B2", "n1", "Действующая", "R1", "M-1, 5 км, City", "1,2"),
        (2, "o", "x", 0, None, None, None, "Реконструкция", None, "", None),
    ]


def test_compatible_classes(spark):
    pairs = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "client_check INT, comp_check INT")
    assert rows(competitors.class_compatible(pairs)) == [(1, 1), (1, 3), (2, 2), (2, 3), (3, 1), (3, 2), (3, 3)]


def test_price_sources(spark):
    price_stations = spark.createDataFrame([(1, 100), (2, 100), (3, None)], "id BIGINT, parcon_id BIGINT")
    day, before = datetime(2024, 1, 31, 23, 59), datetime(2024, 1, 30, 23, 59)
    prices = spark.createDataFrame(
        [
            (1, "api_benzuber", day),
            (1, "api_benzuber", day),
            (2, "api_ppr", day),
            (2, "api_rncard", day),
            (1, "manual_app", before),
            (1, "api_gpn", day),
            (3, "manual_app", day),
            (9, "manual_app", day),
        ],
        "station_id BIGINT, source STRING, updated_at TIMESTAMP",
    )
    sources = competitors.competitor_price_sources(price_stations, prices, AS_OF)
    assert sorted(map(tuple, sources.where("parcon_id IS NOT NULL").collect())) == [
        (100, "api_benzuber", 1),
        (100, "api_ppr", 2),
        (100, "api_rncard", 2),
    ]
    assert rows(competitors.best_price_class(sources)) == [(100, 1, 1)]


def test_manual_class_is_the_best(spark):
    sources = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 0), (1, "c", 0), (2, "a", 2)], "parcon_id BIGINT, source STRING, type_source INT"
    )
    assert rows(competitors.best_price_class(sources)) == [(1, 0, 2), (2, 2, 1)]
