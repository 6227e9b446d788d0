from __future__ import annotations

from helpers import AS_OF, ago, rows, snapshot, table

import pytest
from pyspark.sql import functions as F

from forecourt.operators import activation, expiry, extract, in_report, replacement, summary
from forecourt.plans import enrichment, nearest, visibility


def keys(changes):
    return rows(changes, "station_id", "source", "product_id")


def test_expiry_edges(spark):
    snap = snapshot(
        spark,
        [
            (1, 2, 50.0, "api_gpn", "t", 6),
            (2, 2, 50.0, "api_gpn", "t", 7),
            (2, 3, 50.0, "api_gpn", "t", 9),
            (3, 2, 50.0, "api_ppr", "t", 16),
            (4, 2, 50.0, "api_ppr", "t", 17),
            (5, 2, 50.0, "api_gpn", "f", 30),
            (6, 2, 50.0, "manual_gpn", "t", 30),
        ],
    )
    trusted, untrusted = expiry.off_expired_trusted(snap, AS_OF), expiry.off_expired_untrusted(snap, AS_OF)
    assert rows(trusted, "station_id", "source", "to_date", "new_flag") == [(2, "api_gpn", ago(6), "f")]
    assert rows(untrusted, "station_id", "source", "to_date") == [(4, "api_ppr", ago(16))]
    classes = [("a", ["api_gpn"], 6), ("b", ["api_ppr"], 16)]
    assert rows(expiry.off_expired(snap, AS_OF, classes), "rule", "station_id", "to_date") == [
        ("a", 2, ago(6)),
        ("b", 4, ago(16)),
    ]


def test_error_share_edge(spark):
    products = [2, 3, 4, 41, 173, 174, 175, 176, 177, 181]
    bad = {1: products[:3], 2: products[:4]}
    snap = snapshot(
        spark,
        [(s, p, 1.0 if p in bad[s] else 60.0, "api_gpn", "f", 0) for s in (1, 2) for p in products],
    )
    got = rows(activation.score_new_sources(snap, AS_OF), "station_id", "count_fuel", "check", "count_err")
    assert got == [(1, 10, "OK", 3), (2, 10, "err", None)]
    scored = activation.score_new_sources(snap, AS_OF)
    assert keys(activation.on_partial_trusted(scored, snap, AS_OF)) == [
        (1, "api_gpn", p) for p in sorted(products[3:])
    ]
    assert keys(activation.on_new_trusted(scored, AS_OF)) == []


def test_share_counts_rows_of_all_dates(spark):
    old = [(1, p, 60.0, "api_gpn", "f", 5) for p in (3, 4, 41)]
    snap = snapshot(spark, [(1, 2, 1.0, "api_gpn", "f", 0), *old])
    assert rows(activation.score_new_sources(snap, AS_OF), "count_fuel", "check", "count_err") == [(1, "OK", 1)]


def test_dark_stations(spark):
    snap = snapshot(
        spark,
        [
            (1, 2, 50.0, "api_gpn", "f", 0),
            (2, 2, 50.0, "api_gpn", "f", 0),
            (2, 3, 50.0, "api_ppr", "t", 30),
            (3, 2, 50.0, "api_gpn", "f", 1),
            (4, 2, 0.0, "api_gpn", "f", 0),
            (5, 2, None, "api_gpn", "f", 0),
        ],
    )
    assert rows(summary.dark_stations(snap, AS_OF)) == [(1,)]
    assert rows(activation.score_new_sources(snap, AS_OF), "station_id") == [(1,)]


def test_ranks(spark):
    snap = snapshot(
        spark,
        [
            (1, 2, 60.0, "api_azsgo", "f", 0),
            (2, 2, 60.0, "api_azsgo", "f", 0),
            (2, 2, 60.0, "api_gpn", "f", 0),
            (3, 2, 60.0, "zzz", "f", 0),
            (3, 2, 60.0, "aaa", "f", 0),
        ],
    )
    scored = activation.score_new_sources(snap, AS_OF)
    assert rows(scored, "station_id", "source", "amount") == [(1, "api_azsgo", 1), (2, "api_gpn", 2), (3, "aaa", 2)]
    with pytest.raises(Exception, match="without a rank"):
        activation.score_new_sources(snap, AS_OF, strict_rank=True).collect()


def test_best_source_with_errors_leaves_station_dark(spark):
    snap = snapshot(spark, [(1, 2, 1.0, "api_gpn", "f", 0), (1, 2, 60.0, "api_azsopti", "f", 0)])
    scored = activation.score_new_sources(snap, AS_OF)
    assert rows(scored, "source", "check") == [("api_gpn", "err")]
    assert keys(activation.on_new_trusted(scored, AS_OF)) == []


def test_lowest_price_of_a_duplicate_key_counts(spark):
    snap = snapshot(spark, [(1, 2, 60.0, "api_gpn", "f", 0), (1, 2, 1.0, "api_gpn", "f", 0)])
    assert rows(summary.limit_check(snap, AS_OF), "total", "bad") == [(2, 2)]


def test_rows_without_a_source(spark):
    snap = snapshot(
        spark,
        [
            (1, 2, 60.0, None, "f", 0),
            (2, 2, 60.0, None, "t", 0),
            (2, 2, 60.0, "api_gpn", "f", 0),
            (3, 2, 60.0, None, "t", 0),
            (3, 2, 60.0, "api_gpn", "t", 1),
            (3, 3, 60.0, "api_gpn", "f", 0),
            (4, 2, 60.0, None, "f", 0),
            (4, 2, 60.0, "api_gpn", "f", 0),
        ],
    )
    assert rows(activation.score_new_sources(snap, AS_OF), "station_id", "source", "amount") == [(4, "api_gpn", 1)]
    assert rows(activation.source_candidates(snap, AS_OF), "station_id", "source", "amount") == [(4, "api_gpn", 1)]
    assert rows(in_report.in_report_new_products(snap, AS_OF), "station_id", "source") == [(3, "api_gpn")]
    assert rows(summary.single_source_stations(snap), "station_id", "count_fuel_true") == [(3, 1)]


def test_new_windows(spark):
    snap = snapshot(spark, [(1, 2, 60.0, "api_gpn", "f", 0), (2, 2, 60.0, "api_ppr", "f", 0)])
    scored = activation.score_new_sources(snap, AS_OF)
    columns = ("station_id", "from_date", "to_date", "new_flag")
    assert rows(activation.on_new_trusted(scored, AS_OF), *columns) == [(1, AS_OF, ago(-1), "t")]
    assert rows(activation.on_new_untrusted(scored, AS_OF), *columns) == [(2, ago(14), ago(-1), "t")]


def in_report_case(spark, shown_price, new_price, shown_age=0, product=175):
    return snapshot(
        spark,
        [(1, 3, shown_price, "api_gpn", "t", shown_age), (1, product, new_price, "api_gpn", "f", 0)],
    )


def test_equivalent_product(spark):
    def shown(snap):
        return keys(in_report.on_in_report_new(snap, AS_OF))

    assert shown(in_report_case(spark, 50.0, 50.0)) == []
    assert shown(in_report_case(spark, 50.0, 51.0)) == [(1, "api_gpn", 175)]
    assert shown(in_report_case(spark, 50.0, 50.0, shown_age=1)) == [(1, "api_gpn", 175)]
    assert shown(in_report_case(spark, 60.0, 60.0, product=2)) == [(1, "api_gpn", 2)]
    assert shown(in_report_case(spark, 50.0, 5.0)) == []


def test_in_report_windows(spark):
    snap = snapshot(
        spark,
        [
            (1, 2, 60.0, "manual_gpn", "t", 2),
            (1, 3, 60.0, "manual_gpn", "f", 0),
            (1, 41, 60.0, "manual_gpn", "f", 7),
            (1, 42, 60.0, "manual_gpn", "f", 8),
            (2, 2, 60.0, "api_gpn", "t", 1),
            (2, 3, 60.0, "api_gpn", "f", 0),
            (2, 41, 60.0, "api_gpn", "f", 1),
            (3, 2, 60.0, "api_ppr", "t", 1),
            (3, 3, 60.0, "api_ppr", "f", 0),
            (4, 2, 60.0, "api_gpn", "t", 1),
            (4, 2, 60.0, "api_ppr", "t", 1),
            (4, 3, 60.0, "api_gpn", "f", 0),
        ],
    )
    got = rows(in_report.on_in_report_new(snap, AS_OF), "station_id", "source", "product_id", "from_date")
    assert got == [
        (1, "manual_gpn", 3, ago(7)),
        (1, "manual_gpn", 41, ago(7)),
        (2, "api_gpn", 3, AS_OF),
        (3, "api_ppr", 3, ago(7)),
    ]
    assert keys(in_report.off_stale_in_report(snap, AS_OF)) == [(1, "manual_gpn", 2), (2, "api_gpn", 2)]


def test_replacement(spark):
    snap = snapshot(
        spark,
        [
            (1, 2, 60.0, "api_ppr", "t", 1),
            (1, 2, 60.0, "api_benzuber", "f", 0),
            (1, 3, 1.0, "api_benzuber", "f", 0),
            (1, 2, 60.0, "api_azsgo", "f", 0),
            # two sources shown
            (2, 2, 60.0, "api_ppr", "t", 1),
            (2, 2, 60.0, "manual_app", "t", 1),
            (2, 2, 60.0, "api_gpn", "f", 0),
            # no product of the new source passes; the old one goes off all the same
            (3, 2, 60.0, "api_rncard", "t", 1),
            (3, 2, 1.0, "api_gpn", "f", 0),
            # only an unranked source is offered
            (4, 2, 60.0, "api_fuelup", "t", 1),
            (4, 2, 60.0, "api_azsgo", "f", 0),
            # nothing new
            (5, 2, 60.0, "api_ppr", "t", 1),
            (5, 2, 60.0, "api_gpn", "f", 1),
        ],
    )
    swaps = replacement.source_replacement(snap, AS_OF)
    assert rows(swaps, "station_id", "old_source", "new_source") == [
        (1, "api_ppr", "api_benzuber"),
        (3, "api_rncard", "api_gpn"),
        (4, "api_fuelup", "api_azsgo"),
    ]
    off = replacement.off_replaced_source(swaps)
    assert rows(off, "station_id", "source") == [(1, "api_ppr"), (3, "api_rncard"), (4, "api_fuelup")]
    on = replacement.on_replacing_source(swaps, snap, AS_OF)
    assert keys(on) == [(1, "api_benzuber", 2), (4, "api_azsgo", 2)]


def test_count_race(spark):
    yandex, benzuber = "api_yandex_fuel", "api_benzuber"
    snap = snapshot(
        spark,
        [
            (1, 2, 60.0, yandex, "t", 3),
            (1, 2, 60.0, benzuber, "f", 0),
            (2, 2, 60.0, yandex, "t", 3),
            (2, 3, 60.0, yandex, "t", 3),
            (2, 2, 60.0, benzuber, "f", 0),
            (3, 2, 60.0, yandex, "t", 3),
            (3, 2, 60.0, benzuber, "f", 0),
            (3, 3, 1.0, benzuber, "f", 9),
        ],
    )
    race = replacement.count_race(snap, AS_OF)
    assert rows(race, "station_id", "rival_rows", "shown_rows", "rival_bad") == [(1, 1, 1, 0), (3, 1, 1, 1)]
    assert rows(replacement.off_yandex_for_benzuber(race), "station_id", "source") == [(1, yandex)]
    assert rows(replacement.on_benzuber(race, AS_OF), "station_id", "source", "from_date") == [(1, benzuber, AS_OF)]


def test_bounds(spark):
    snap = snapshot(
        spark,
        [
            (1, 178, 10.5, "a", "t", 0),
            (1, 2, 11.0, "a", "t", 0),
            (1, 3, 110.0, "a", "t", 0),
            (1, 4, 110.1, "a", "t", 0),
            (1, 41, 5.0, "a", "f", 0),
            (1, 42, None, "a", "t", 0),
        ],
    )
    assert keys(expiry.off_out_of_bounds(snap)) == [(1, "a", 4), (1, "a", 178)]
    assert keys(expiry.off_products_beyond(summary.product_summary(snap, AS_OF))) == [(1, "a", 4), (1, "a", 178)]


def test_diesel(spark):
    snap = snapshot(
        spark,
        [
            (1, 182, 60.0, "a", "t", 1),
            (1, 176, 60.0, "a", "t", 1),
            (2, 176, 60.0, "a", "t", 1),
            (2, 181, 61.0, "a", "t", 1),
            (3, 176, 60.0, "a", "t", 1),
            (3, 176, 60.0, "b", "t", 4),
            (4, 176, None, "a", "t", 1),
            (4, 181, None, "a", "t", 2),
            (5, 176, None, "a", "t", 1),
            (5, 181, 60.0, "a", "t", 2),
            (6, 176, 60.0, "a", "t", 1),
        ],
    )
    got = rows(expiry.off_old_diesel(snap), "station_id", "product_id", "only_flag")
    assert got == [(1, 176, "t"), (3, 176, "t"), (4, 181, "t")]


def test_recency_and_scope_edges(spark):
    prices = table(
        spark,
        [(1, age, 60.0, "a", "t", age) for age in (59, 60, 61)]
        + [(1, 100 + age, 60.0, "a", "f", age) for age in (20, 21, 22)]
        + [(1, 200, 60.0, "a", None, 0), (2, 1, 60.0, "a", "t", 0), (3, 1, 60.0, "a", "t", 0)]
        + [(s, 1, float("nan"), "a", "t", 0) for s in (4, 5, 6)],
    )
    stations = spark.createDataFrame([(1, 85), (2, 86), (3, None), (4, 1), (5, 1), (6, 1)], "id BIGINT, region_id INT")
    customer_stations = spark.createDataFrame([(10, 4, 100), (11, 6, 101)], "id BIGINT, station_id BIGINT, customer_id BIGINT")
    customers = spark.createDataFrame([(100, "trial"), (101, "lead")], "id BIGINT, status STRING")
    competitors = spark.createDataFrame(
        [(5, 10), (None, 10), (6, 11)], "station_id BIGINT, customer_station_id BIGINT"
    )
    got = extract.price_extract(prices, stations, customer_stations, customers, competitors, AS_OF)
    assert rows(got, "station_id", "product_id") == [(1, 59), (1, 60), (1, 120), (1, 121), (6, 1)]
    assert got.where(F.col("station_id") == 6).first()["price"] is None


def test_empty_snapshot(spark):
    snap = snapshot(spark, [])
    scored = activation.score_new_sources(snap, AS_OF)
    assert rows(scored) == []
    assert rows(in_report.on_in_report_new(snap, AS_OF)) == []
    assert rows(activation.on_partial_trusted(scored, snap, AS_OF)) == []


def test_row_order_does_not_matter(spark):
    per_station = [(2, "api_gpn", "f", 0), (3, "api_ppr", "f", 0), (4, "api_gpn", "f", None)]
    data = [(s, p, 40.0 + p, src, f, s if a is None else a) for s in range(6) for p, src, f, a in per_station]
    one, other = snapshot(spark, data), snapshot(spark, data[::-1]).repartition(7)
    assert rows(activation.score_new_sources(one, AS_OF)) == rows(activation.score_new_sources(other, AS_OF))


def without_keys(source="api_gpn", flag="f", age=0):
    """Rows with a missing source, product or both, at the stations the tests use."""
    return [(s, p, 60.0, src, flag, age) for s in (1, 2, 3) for p, src in ((None, source), (None, None), (3, None))]


def all_keyed(changes, *columns):
    assert changes.where(" or ".join(f"{c} is null" for c in columns)).count() == 0
    return rows(changes, *columns)


def test_partial_sources_without_keys(spark):
    """R6, R7: a missing product or source is shown by no change, whatever it adds to the counts."""
    for source, rule in (("api_gpn", activation.on_partial_trusted), ("api_ppr", activation.on_partial_untrusted)):
        known = [(1, p, 60.0, source, "f", 0) for p in (2, 4, 41, 173)] + [(1, 174, 1.0, source, "f", 0)]
        snap = snapshot(spark, known + without_keys(source))
        made = rule(activation.score_new_sources(snap, AS_OF), snap, AS_OF)
        assert all_keyed(made, "station_id", "source", "product_id") == [(1, source, p) for p in (2, 4, 41, 173)]


def test_in_report_rules_without_keys(spark):
    """R8, R9."""
    known = [(1, 2, 60.0, "api_gpn", "t", 0), (1, 4, 61.0, "api_gpn", "f", 0), (1, 41, 62.0, "api_gpn", "t", 2)]
    snap = snapshot(spark, known + without_keys() + [(1, None, 60.0, "api_gpn", "t", 2)])
    assert all_keyed(in_report.on_in_report_new(snap, AS_OF), "station_id", "source", "product_id") == [(1, "api_gpn", 4)]
    assert all_keyed(in_report.off_stale_in_report(snap, AS_OF), "station_id", "source", "product_id") == [(1, "api_gpn", 41)]


def test_replacement_without_keys(spark):
    """R11, and R10 beside it: a row without a source replaces nothing and is not replaced."""
    known = [(1, 2, 60.0, "api_ppr", "t", 1), (1, 2, 60.0, "api_gpn", "f", 0), (1, 4, 60.0, "api_gpn", "f", 0)]
    snap = snapshot(spark, known + without_keys())
    swaps = replacement.source_replacement(snap, AS_OF)
    assert rows(swaps, "station_id", "old_source", "new_source") == [(1, "api_ppr", "api_gpn")]
    made = replacement.on_replacing_source(swaps, snap, AS_OF)
    assert all_keyed(made, "station_id", "source", "product_id") == [(1, "api_gpn", 2), (1, "api_gpn", 4)]
    assert all_keyed(replacement.off_replaced_source(swaps), "station_id", "source") == [(1, "api_ppr")]


@pytest.mark.parametrize("price", [1e300, 12345678.901])
def test_prices_are_equal_to_the_kopeck(spark, price):
    candidates = spark.createDataFrame([(1, "a", 2, 60.004), (1, "a", 3, price), (1, "a", 4, 60.006)], "station_id bigint, source string, product_id bigint, new_price double")
    shown = spark.createDataFrame([(1, "a", 174, 59.996), (1, "a", 175, price), (1, "a", 41, 60.0)], "station_id bigint, source string, product_id bigint, shown_price double")
    found = rows(in_report.equivalent_product_dup(candidates, shown), "product_id")
    assert found == ([(2,)] if price > 1e20 else [(2,), (3,)])


@pytest.mark.parametrize("plan", ["visibility", "nearest", "company"])
def test_another_time_zone_is_refused(spark, plan):
    nothing = spark.range(0)
    run = {
        "visibility": lambda: visibility.price_visibility(visibility.PriceTables(*[nothing] * 5), AS_OF),
        "nearest": lambda: nearest.nearest_competitors(nearest.StationTables(*[nothing] * 6), 5, AS_OF),
        "company": lambda: enrichment.company_table(nothing, nothing),
    }
    spark.conf.set("spark.sql.session.timeZone", "Asia/Omsk")
    try:
        with pytest.raises(ValueError, match="Asia/Omsk"):
            run[plan]()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
