from __future__ import annotations

from datetime import datetime

import pytest
from helpers import AS_OF, TABLE, ago, rows, snapshot, table
from pyspark.sql import functions as F

from forecourt.operators import expiry
from forecourt.operators.changes import CHANGE_SCHEMA, apply_changes, change, change_report, change_text, union_all


def changes(spark, *data):
    """(rule, station, source, product, from, to, only, new)."""
    return spark.createDataFrame(list(data), CHANGE_SCHEMA)


def flags(df):
    return rows(df, "station_id", "product_id", "source", "show_in_report", "updated_by_id")


def test_every_grain(spark):
    prices = table(spark, [(1, p, 60.0, s, "t", 0) for p in (2, 3) for s in ("a", "b")])
    off = ("off_out_of_bounds", 1)
    by_source = changes(spark, (*off, "a", None, None, None, None, "f"))
    assert flags(apply_changes(prices, by_source)) == [
        (1, 2, "a", "f", 1), (1, 2, "b", "t", 0), (1, 3, "a", "f", 1), (1, 3, "b", "t", 0),
    ]
    by_key = changes(spark, (*off, "a", 3, None, None, None, "f"))
    assert [f[3] for f in flags(apply_changes(prices, by_key))] == ["t", "t", "f", "t"]
    by_product = changes(spark, (*off, None, 2, None, None, None, "f"))
    assert [f[3] for f in flags(apply_changes(prices, by_product))] == ["f", "f", "t", "t"]
    nobody = changes(spark, ("off_out_of_bounds", 9, "a", None, None, None, None, "f"))
    assert flags(apply_changes(prices, nobody)) == flags(prices)


def test_dates_are_half_open(spark):
    prices = spark.createDataFrame(
        [
            (1, 1, 60.0, "a", "f", datetime(2024, 1, 30, 23, 59), 0),
            (1, 2, 60.0, "a", "f", datetime(2024, 1, 31, 0, 0), 0),
            (1, 3, 60.0, "a", "f", datetime(2024, 1, 31, 23, 59), 0),
            (1, 4, 60.0, "a", "f", datetime(2024, 2, 1, 0, 0), 0),
            (1, 5, 60.0, "a", "f", None, 0),
        ],
        TABLE,
    )
    day = changes(spark, ("on_benzuber", 1, "a", None, AS_OF, ago(-1), None, "t"))
    assert [f[3] for f in flags(apply_changes(prices, day))] == ["f", "t", "t", "f", "f"]


def test_later_rules_win_and_see_the_flag_before(spark):
    prices = table(spark, [(1, 2, 60.0, "a", "f", 0), (1, 3, 60.0, "a", "f", 0), (1, 4, 60.0, "a", None, 0)])
    both = changes(
        spark,
        ("off_out_of_bounds", 1, "a", 2, None, None, None, "f"),
        ("on_benzuber", 1, "a", None, None, None, None, "t"),
        ("off_old_diesel", 1, None, 3, None, None, "t", "f"),
    )
    assert flags(apply_changes(prices, both)) == [(1, 2, "a", "f", 1), (1, 3, "a", "f", 1), (1, 4, "a", "t", 1)]
    guarded = changes(spark, ("off_old_diesel", 1, None, 3, None, None, "t", "f"))
    assert flags(apply_changes(prices, guarded)) == flags(prices)


def test_idempotent(spark):
    prices = table(spark, [(s, p, 60.0, "a", "f", s) for s in range(5) for p in range(5)])
    some = changes(
        spark,
        ("on_benzuber", 1, "a", None, None, None, None, "t"),
        ("off_out_of_bounds", 1, "a", 2, None, None, None, "f"),
        ("off_stale_in_report", 3, "a", 4, ago(3), None, None, "t"),
    )
    once = apply_changes(prices, some)
    assert flags(apply_changes(once, some)) == flags(once)


def test_nothing_to_do(spark):
    prices = table(spark, [(1, 2, 60.0, "a", "t", 0)])
    out = apply_changes(prices, changes(spark))
    assert flags(out) == flags(prices)
    assert out.columns == prices.columns
    assert [f.dataType for f in out.schema] == [f.dataType for f in prices.schema]


def test_duplicate_rows_are_kept(spark):
    prices = table(spark, [(1, 2, 60.0, "a", "t", 0), (1, 2, 60.0, "a", "t", 0), (1, 2, 61.0, "a", "t", 3)])
    off = changes(spark, ("off_out_of_bounds", 1, "a", 2, None, None, None, "f"))
    assert flags(apply_changes(prices, off)) == [(1, 2, "a", "f", 1)] * 3


def test_change_schema_and_text(spark):
    keys = spark.createDataFrame([(1, "a", 2)], "station_id BIGINT, source STRING, product_id BIGINT")
    made = union_all([change(keys, "x", "t", AS_OF, ago(-1), "f"), change(keys.drop("source"), "y", "f")])
    assert made.schema.simpleString() == f"struct<{CHANGE_SCHEMA.replace(' ', ':').replace(',:', ',')}>"
    assert rows(change_text(made)) == [
        (
            "x",
            "station_id = 1 and source = 'a' and product_id = 2 and updated_at >= 2024-01-31 "
            "and updated_at < 2024-02-01 and show_in_report = 'f'",
        ),
        ("y", "station_id = 1 and product_id = 2"),
    ]


def test_station_grain(spark):
    prices = table(spark, [(1, 2, 60.0, "a", "t", 0), (1, 3, 60.0, None, "t", 0), (2, 2, 60.0, "a", "t", 0)])
    whole = changes(spark, ("off_out_of_bounds", 1, None, None, None, None, None, "f"))
    assert {(f[0], f[3]) for f in flags(apply_changes(prices, whole))} == {(1, "f"), (2, "t")}


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_what_would_be_ignored_fails(spark, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    prices = table(spark, [(1, 2, 60.0, "a", "t", 0)])
    unknown = changes(spark, ("no_such_rule", 1, "a", None, None, None, None, "f"))
    with pytest.raises(Exception, match="without a place"):
        apply_changes(prices, unknown).collect()
    product = changes(spark, ("off_old_diesel", 1, None, 2, None, None, None, "f"))
    with pytest.raises(Exception, match="not applied"):
        apply_changes(prices, product, grains=("source",)).collect()
    nowhere = changes(spark, ("off_old_diesel", None, None, 2, None, None, None, "f"))
    with pytest.raises(Exception, match="not applied"):
        apply_changes(prices, nowhere).collect()
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_missing_key_never_widens_an_update(spark):
    prices = [(1, 2, 5.0, None, "t", 0), (1, 2, 60.0, "api_gpn", "t", 0), (2, None, 5.0, "api_gpn", "t", 0), (2, 2, 60.0, "api_gpn", "t", 0)]
    made = expiry.off_out_of_bounds(snapshot(spark, prices))
    assert made.count() == 0
    given = table(spark, prices)
    done = apply_changes(given, made).select("station_id", "price", "show_in_report").collect()
    assert {r["show_in_report"] for r in done} == {"t"} and len(done) == 4
    keys = spark.createDataFrame([(1, "a", None), (1, "b", 2)], "station_id bigint, source string, product_id bigint")
    assert rows(change(keys, "x", "f"), "source", "product_id") == [("b", 2)]
    assert rows(change(keys, "x", "f", grain="source"), "source", "product_id") == [("a", None), ("b", None)]


def test_both_ways_agree(spark):
    """Broadcast changes and outcomes by key give the same table, missing keys and all."""
    prices = table(
        spark,
        [(s, p, 60.0, src, f, a) for s in (1, 2, None) for p in (2, None) for src in ("a", None) for f in ("t", "f", None) for a in (0, 5)]
        + [(1, 2, 60.0, "a", "t", 0)] * 3,
    )
    prices = prices.union(prices.limit(2).withColumn("updated_at", F.lit(None).cast("timestamp")))
    some = changes(
        spark,
        ("on_benzuber", 1, "a", None, AS_OF, None, None, "t"),
        ("off_expired_trusted", 1, "a", None, None, ago(2), None, "f"),
        ("off_out_of_bounds", 1, "a", 2, None, None, "t", "f"),
        ("off_old_diesel", 1, None, 2, None, None, "t", "f"),
        ("off_old_diesel", 2, None, None, None, None, "f", "t"),
    )
    direct, by_key = (apply_changes(prices, some, broadcast_rows=n) for n in (100, 0))
    assert direct.columns == by_key.columns == prices.columns
    assert sorted(map(repr, direct.collect())) == sorted(map(repr, by_key.collect()))
    assert direct.where("updated_by_id = 1").count() > 5
    with pytest.raises(ValueError, match="not applied"):
        apply_changes(prices, some, grains=("source",), broadcast_rows=0)


def test_reports_join_lines_in_bounded_texts(spark):
    some = changes(
        spark,
        *[("off_out_of_bounds", 1, "a", p, None, None, None, "f") for p in range(7)],
        ("on_benzuber", 1, "a", None, None, None, None, "t"),
        ("on_benzuber", 2, None, None, None, None, None, "t"),
    )
    lines = sorted(f"station_id = 1 and source = 'a' and product_id = {p}" for p in range(7))
    assert rows(change_report(some, 3)) == [
        ("off_out_of_bounds", 1, 0, 3, "; ".join(lines[:3])),
        ("off_out_of_bounds", 1, 1, 3, "; ".join(lines[3:6])),
        ("off_out_of_bounds", 1, 2, 1, lines[6]),
        ("on_benzuber", 1, 0, 1, "station_id = 1 and source = 'a'"),
        ("on_benzuber", 2, 0, 1, "station_id = 2"),
    ]
    assert rows(change_report(some.limit(0))) == []
