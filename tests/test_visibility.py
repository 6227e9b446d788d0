"""The staged run on hand-made stations, one or more per rule."""

from __future__ import annotations

import pytest
from helpers import AS_OF, plan, rows, table

from forecourt.operators import extract, summary
from forecourt.operators.changes import joined_in_place, outcomes_in_place
from forecourt.plans.visibility import (
    WORKING_COLUMNS,
    PriceTables,
    expiry_changes,
    parts_of,
    price_visibility,
    visibility_changes,
)

GPN, PPR, YANDEX, BENZUBER = "api_gpn", "api_ppr", "api_yandex_fuel", "api_benzuber"

# station, product, price, source, flag, age in days -> flag afterwards, touched
CASES = [
    # expired, with a row too old for the extraction
    ((1, 2, 60.0, GPN, "t", 7), ("f", 1)),
    ((1, 3, 60.0, GPN, "t", 100), ("f", 1)),
    # dark, trusted source; a row without a flag is switched on too
    ((2, 2, 60.0, GPN, "f", 0), ("t", 1)),
    ((2, 3, 60.0, GPN, None, 0), ("t", 1)),
    # dark, untrusted source
    ((3, 2, 60.0, PPR, "f", 0), ("t", 1)),
    ((3, 3, 60.0, PPR, "f", 13), ("t", 1)),
    ((3, 4, 60.0, PPR, "f", 15), ("f", 0)),
    # dark, one bad price in four
    ((4, 2, 60.0, GPN, "f", 0), ("t", 1)),
    ((4, 3, 60.0, GPN, "f", 0), ("t", 1)),
    ((4, 4, 60.0, GPN, "f", 0), ("t", 1)),
    ((4, 41, 1.0, GPN, "f", 0), ("f", 0)),
    # replacement
    ((5, 2, 60.0, PPR, "t", 1), ("f", 1)),
    ((5, 2, 60.0, GPN, "f", 0), ("t", 1)),
    # the rival has as many rows; its price is below the bound for all fuels but within its limits
    ((6, 3, 60.0, YANDEX, "t", 1), ("f", 1)),
    ((6, 178, 10.5, BENZUBER, "f", 0), ("t", 1)),
    # out of bounds
    ((7, 2, 5.0, GPN, "t", 0), ("f", 1)),
    # a new product beside the one shown
    ((8, 2, 60.0, GPN, "t", 0), ("t", 0)),
    ((8, 3, 60.0, GPN, "f", 0), ("t", 1)),
    # a new product in place of an older one
    ((9, 2, 60.0, GPN, "t", 2), ("f", 1)),
    ((9, 3, 60.0, GPN, "f", 0), ("t", 1)),
    # diesel twice at one price: the older goes, from every source
    ((10, 176, 60.0, GPN, "t", 0), ("t", 0)),
    ((10, 181, 60.0, GPN, "t", 1), ("f", 1)),
    ((10, 181, 99.0, "manual_gpn", "t", 70), ("f", 1)),
    # not in scope: region, client, competitor
    ((11, 2, 60.0, GPN, "t", 30), ("t", 0)),
    ((12, 2, 60.0, GPN, "t", 30), ("t", 0)),
    ((13, 2, 60.0, GPN, "t", 30), ("t", 0)),
    # the best source has only bad prices
    ((14, 2, 1.0, GPN, "f", 0), ("f", 0)),
    ((14, 2, 60.0, "api_azsopti", "f", 0), ("f", 0)),
    # hidden by expiry in the first stage, dark in the second, shown from another source
    ((15, 2, 60.0, PPR, "t", 20), ("f", 1)),
    ((15, 2, 60.0, GPN, "f", 0), ("t", 1)),
    # switched on in the second stage, diesel in the last
    ((16, 176, 60.0, GPN, "f", 0), ("f", 1)),
    ((16, 182, 60.0, GPN, "f", 0), ("t", 1)),
]


@pytest.fixture
def tables(spark):
    return PriceTables(
        prices=table(spark, [case for case, _ in CASES]),
        stations=spark.createDataFrame([(s, 90 if s == 11 else 1) for s in range(1, 17)], "id BIGINT, region_id INT"),
        customer_stations=spark.createDataFrame([(1, 12, 1)], "id BIGINT, station_id BIGINT, customer_id BIGINT"),
        customers=spark.createDataFrame([(1, "client")], "id BIGINT, status STRING"),
        competitors=spark.createDataFrame([(13, 1)], "station_id BIGINT, customer_station_id BIGINT"),
    )


def test_every_case(tables):
    done = price_visibility(tables, AS_OF)
    got = {tuple(r[:3]): tuple(r[3:]) for r in rows(done, "station_id", "product_id", "source", "show_in_report", "updated_by_id")}
    assert got == {(s, p, src): after for (s, p, _, src, _, _), after in CASES}
    assert done.columns == tables.prices.columns


def test_changes_name_their_rules(tables):
    by_rule = {}
    for rule, station in rows(visibility_changes(tables, AS_OF)[0], "rule", "station_id"):
        by_rule.setdefault(rule, set()).add(station)
    assert by_rule == {
        "off_expired_trusted": {1},
        "off_expired_untrusted": {15},
        "on_new_trusted": {2, 15, 16},
        "on_new_untrusted": {3},
        "on_partial_trusted": {4},
        "off_replaced_source": {5},
        "on_replacing_source": {5},
        "off_yandex_for_benzuber": {6},
        "on_benzuber": {6},
        "off_out_of_bounds": {7},
        "on_in_report_new": {8, 9},
        "off_stale_in_report": {9},
        "off_old_diesel": {10, 16},
    }


def test_nothing_in_the_tables(spark, tables):
    empty = PriceTables(**{name: getattr(tables, name).limit(0) for name in PriceTables.__dataclass_fields__})
    assert rows(price_visibility(empty, AS_OF)) == []


def spread_and_in_buckets(tables, **limits):
    return rows(price_visibility(tables, AS_OF, broadcast_rows=0, **limits), "station_id", "product_id", "source", "show_in_report", "updated_by_id")


def test_stations_in_buckets_and_stations_with_many_rows_agree(tables):
    """Buckets of few rows, and some or all stations too large for one: the same outcome, that of every case."""
    expected = sorted((s, p, src, *after) for (s, p, _, src, _, _), after in CASES)
    assert spread_and_in_buckets(tables) == expected
    assert spread_and_in_buckets(tables, bucket_rows=10, station_rows=2) == expected


def test_stages_shuffle_no_rows_of_a_bucket(spark, tables, tmp_path):
    """Summaries, changes and rows in buckets of stations are grouped and joined where they are."""
    part = parts_of(tables.prices.select(*WORKING_COLUMNS), bucket_rows=10)[0]
    assert part.buckets > 1
    with part.planning():
        snapshot = extract.as_snapshot(part.rows, AS_OF)
        products = part.keep()(summary.product_summary(snapshot, AS_OF), "products")
        assert "Exchange hashpartitioning" not in plan(summary.product_summary(snapshot, AS_OF))
        changes = part.keep()(expiry_changes(snapshot, AS_OF), "changes")
        stages = [(changes, ("source", "source_product", "product"))]
        assert "Exchange hashpartitioning" not in plan(joined_in_place(part.rows, stages))
        assert "Exchange hashpartitioning" not in plan(outcomes_in_place(part.rows, stages))
        assert "Exchange hashpartitioning" not in plan(summary.judge_sources(products))
