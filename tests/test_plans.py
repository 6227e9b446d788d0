"""What the physical plans must and must not have."""

from __future__ import annotations

import pytest
from helpers import AS_OF, plan, rows, table
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.operators import activation, competitors, expiry, extract, in_report, knn
from forecourt.operators.changes import CHANGE_SCHEMA, RULE_ORDER, apply_changes, outcomes


@pytest.fixture
def stored(spark, tmp_path):
    made = table(spark, [(s, p, 60.0, "api_ppr", "t", 1) for s in range(50) for p in (2, 3)])
    made.withColumn("unused", F.lit("x")).write.parquet(str(tmp_path / "prices"))
    return spark.read.parquet(str(tmp_path / "prices"))


def test_extraction_reaches_the_scan(spark, stored):
    text = extract.as_snapshot(stored, AS_OF)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "GreaterThan(updated_at,2023-12-02" in pushed
    schema = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "unused" not in schema and "updated_by_id" not in schema


def test_rules_read_only_what_they_need(spark, stored):
    snap = extract.as_snapshot(stored, AS_OF)
    text = expiry.off_out_of_bounds(snap)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "EqualTo(show_in_report,t)" in pushed
    schema = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "unused" not in schema and "updated_by_id" not in schema


def test_scoring_shuffles_three_times(spark, stored):
    text = plan(activation.score_new_sources(extract.as_snapshot(stored, AS_OF), AS_OF))
    assert text.count("Exchange hashpartitioning") == 3
    assert text.count("Join") == 1 and "BroadcastHashJoin" in text  # the price limits


def test_diesel_shuffles_once(spark, stored):
    text = plan(expiry.off_old_diesel(extract.as_snapshot(stored, AS_OF)))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_protected_stations_are_an_anti_join(spark, stored):
    protected = spark.createDataFrame([(1,)], "station_id BIGINT")
    assert "LeftAnti" in plan(extract.exclude_stations(stored, protected))


@pytest.fixture
def shuffling(spark):
    """Large-cluster behaviour on small data: no broadcast, hot partitions split early."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_table(spark, hot=40_000, rest=40_000):
    """Half of the rows at station 7, source 's1'."""
    n = F.col("id")
    is_hot = n < hot
    return spark.range(0, hot + rest, 1, 16).select(
        F.when(is_hot, 7).otherwise(n % 5000 + 100).cast("bigint").alias("station_id"),
        (n % 9973).alias("product_id"),
        F.lit(60.0).alias("price"),
        F.when(is_hot, "s1").otherwise(F.concat(F.lit("s"), (n % 7).cast("string"))).alias("source"),
        F.when(n % 3 == 0, "t").otherwise("f").alias("show_in_report"),
        F.lit("2024-01-31 10:00:00").cast("timestamp").alias("updated_at"),
        F.lit(0).cast("bigint").alias("updated_by_id"),
        F.sha2(n.cast("string"), 256).alias("padding"),
    )


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    query = df._jdf.queryExecution()
    query.toRdd().count()
    return query.executedPlan().toString()


def hot_changes(spark):
    stations = [(7, "s1")] + [(s, "s1") for s in range(100, 400)]
    data = [("off_out_of_bounds", s, src, None, None, None, None, "f") for s, src in stations]
    by_product = [("off_old_diesel", 7, None, p, None, None, "t", "f") for p in range(20)]
    return spark.createDataFrame(data + by_product, CHANGE_SCHEMA)


def test_a_hot_station_is_split_when_changes_are_applied(shuffling):
    prices, changes = hot_table(shuffling), hot_changes(shuffling)
    narrow = outcomes(prices, changes, RULE_ORDER, ("source", "product"))
    assert "skew=true" in final_plan(narrow)
    out = apply_changes(prices, changes, grains=("source", "product"), broadcast_rows=0)
    expected = prices.join(changes.select("station_id", "source"), ["station_id", "source"], "left_semi").count()
    counts = dict(map(tuple, out.groupBy("updated_by_id").count().collect()))
    assert counts == {1: expected, 0: 80_000 - expected}


def test_the_wide_table_is_shuffled_once_at_most(shuffling, tmp_path):
    hot_table(shuffling).write.parquet(str(tmp_path / "wide"))
    prices, changes = shuffling.read.parquet(str(tmp_path / "wide")), hot_changes(shuffling)
    few = plan(apply_changes(prices, changes))
    assert "SortMergeJoin" not in few and few.count("BroadcastHashJoin") == 4
    many = plan(apply_changes(prices, changes, broadcast_rows=0))
    assert many.count("SortMergeJoin") == 1 and many.count("Exchange hashpartitioning") == 2 and "Broadcast" not in many
    wide = [line for line in many.splitlines() if "FileScan" in line and "padding" in line]
    assert len(wide) == 1


def test_rows_with_one_key_are_split(shuffling):
    """Half of the table agrees in every column that decides."""
    prices = hot_table(shuffling).withColumn("product_id", F.when(F.col("station_id") == 7, 2).otherwise(F.col("product_id")))
    prices = prices.withColumn("show_in_report", F.lit("t"))
    out = apply_changes(prices, hot_changes(shuffling), broadcast_rows=0)
    assert "skew=true" in final_plan(out)
    assert out.where("station_id = 7 and show_in_report = 'f'").count() == 40_000


def test_a_hot_station_is_split_when_stations_are_excluded(shuffling):
    spark = shuffling
    ids = spark.range(0, 4000).select((F.col("id") + 200).alias("id"), F.lit(1).alias("region_id"))
    stations = ids.union(spark.createDataFrame([(7, 1)], "id BIGINT, region_id INT"))
    links = spark.createDataFrame([(1, 300, 1)], "id BIGINT, station_id BIGINT, customer_id BIGINT")
    customers = spark.createDataFrame([(1, "client")], "id BIGINT, status STRING")
    rivals = spark.createDataFrame([(301, 1)], "station_id BIGINT, customer_station_id BIGINT")
    prices = hot_table(spark)
    kept = extract.in_scope(prices, stations, links, customers, rivals)
    assert "skew=true" in final_plan(kept)
    inside = "station_id = 7 OR (station_id BETWEEN 200 AND 4199 AND station_id NOT IN (300, 301))"
    assert kept.count() == prices.where(inside).count()
    protected = extract.protected_stations(links.select("id", "station_id"), rivals)
    left = extract.exclude_stations(prices, protected)
    assert "skew=true" in final_plan(left)


def test_a_hot_source_is_split_in_the_rules(shuffling):
    spark = shuffling
    snap = extract.as_snapshot(hot_table(spark).drop("padding"), AS_OF)
    new = in_report.on_in_report_new(snap, AS_OF)
    assert "skew=true" in final_plan(new)
    at_hot = snap.where("station_id = 7")
    hidden = {p for (p,) in rows(at_hot.where("show_in_report = 'f'"), "product_id")}
    shown = {p for (p,) in rows(at_hot.where("show_in_report = 't'"), "product_id")}
    groups = [set(g) for g in refdata.EQUIVALENT_PRODUCTS]
    twins = {p for p in hidden for g in groups if p in g and shown & (g - {p})}
    too_dear = {p for p, (_, hi) in refdata.PRICE_LIMITS.items() if hi < 60.0}
    assert {p for (p,) in rows(new.where("station_id = 7"), "product_id")} == hidden - twins - too_dear


def test_a_competitor_of_half_the_stations_is_split(shuffling):
    spark = shuffling
    n = F.col("id")
    names = ("type_1", "brand", "affilation", "number", "status", "region", "address", "gps")
    directory = spark.range(0, 30_000).select(
        n.alias("id_parcon"), F.lit("АЗС").alias("type_azs"), F.lit(1).alias("check"), *(F.lit("x").alias(c) for c in names)
    )
    pairs = spark.range(0, 30_000, 1, 16).select(
        n.alias("point1"),
        F.when(n % 2 == 0, 5).otherwise(n).cast("bigint").alias("point2"),
        F.lit(1).alias("rank"),
        F.lit(1.0).alias("dist, km"),
    )
    sources = spark.range(0, 30_000).select(n.alias("parcon_id"), F.lit("s").alias("source"), F.lit(1).alias("type_source"))
    table = competitors.nearest_competitors(
        competitors.competitor_enrich(pairs, directory), competitors.best_price_class(sources)
    )
    assert final_plan(table).count("skew=true") >= 2
    assert table.where("id_parcon = 5 AND type_source = 1").count() == 15_001
    assert table.count() == 30_000


def test_a_spot_of_half_the_points_is_split(shuffling):
    spark = shuffling
    n = F.col("id")
    points = spark.range(0, 20_000, 1, 16).select(
        "id",
        F.when(n % 2 == 0, 50.0).otherwise(40 + n / 1000).alias("lat"),
        F.when(n % 2 == 0, 30.0).otherwise(20 + (n * 7919 % 20_000) / 1000).alias("lon"),
    )
    pairs = knn.knn_pairs(points, 3)
    assert "skew=true" in final_plan(pairs)
    assert pairs.count() == 60_000
    at_spot = pairs.where("point1 % 2 = 0").groupBy("rank", "point2").count().collect()
    assert sorted(map(tuple, at_spot)) == [(1, 0, 10_000), (2, 2, 10_000), (3, 4, 10_000)]


def test_a_task_does_not_grow_with_a_shuffle(spark):
    """However few partitions the session has, a task reads a bounded part of a large shuffle."""
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    made = spark.range(2_000_000).select(F.sha2(F.col("id").cast("string"), 256).alias("key")).groupBy("key").count()
    tasks = made.select(F.spark_partition_id().alias("part")).agg(F.countDistinct("part")).first()[0]
    assert tasks >= 8
    few = spark.range(200).groupBy((F.col("id") % 7).alias("key")).count().select(F.spark_partition_id().alias("part")).agg(F.countDistinct("part"))
    assert few.first()[0] == 1


def test_rows_meet_only_grains_that_have_changes(shuffling):
    """One join and its two shuffles for changes of one grain, and the rows are not gathered again."""
    changes = hot_changes(shuffling).where("product_id IS NULL")
    text = plan(outcomes(hot_table(shuffling), changes, RULE_ORDER, ("source", "source_product", "product", "station")))
    assert text.count("SortMergeJoin") == 1 and "collect_list" not in text
