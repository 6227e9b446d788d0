from __future__ import annotations

import numpy as np
import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from forecourt.operators import knn
from forecourt.session import materialise

SCHEMA = "id BIGINT, lat DOUBLE, lon DOUBLE"


def brute_force(data, k, include_self=True):
    ids = np.array([d[0] for d in data])
    lat, lon = np.radians([d[1] for d in data]), np.radians([d[2] for d in data])
    h = (
        np.sin((lat[None] - lat[:, None]) / 2) ** 2
        + np.cos(lat[:, None]) * np.cos(lat[None]) * np.sin((lon[None] - lon[:, None]) / 2) ** 2
    )
    km = np.round(2 * 6371 * np.arcsin(np.sqrt(np.minimum(1, h))), 6)
    out = []
    for i, point in enumerate(ids):
        order = [j for j in np.lexsort((ids, km[i])) if include_self or j != i]
        out += [(int(point), int(ids[j]), n, float(km[i, j])) for n, j in enumerate(order[:k], 1)]
    return sorted(out)


def check(spark, data, k, **options):
    include_self = options.get("include_self", True)
    got = rows(knn.knn_pairs(spark.createDataFrame(data, SCHEMA), k, **options))
    want = brute_force(data, k, include_self)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=2e-6)


def sphere(rng, n, start=0):
    lat, lon = np.degrees(np.arcsin(rng.uniform(-1, 1, n))), rng.uniform(-180, 180, n)
    return [(start + i, float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))]


@pytest.mark.parametrize("k", [1, 4, 17])
def test_random_points_on_the_whole_sphere(spark, k):
    check(spark, sphere(np.random.default_rng(k), 400), k, tile_rows=64, leaf_spots=8)


def test_seam_and_poles(spark):
    rng = np.random.default_rng(1)
    seam = [(i, float(rng.uniform(-1, 1)), float(s * (180 - rng.uniform(0, 0.5)))) for i, s in enumerate([1, -1] * 60)]
    poles = [(200 + i, float(s * (90 - rng.uniform(0, 0.5))), float(rng.uniform(-180, 180))) for i, s in enumerate([1, -1] * 60)]
    check(spark, seam + poles, 5, tile_rows=32, leaf_spots=4)


def test_a_third_of_the_points_at_one_spot_and_a_third_in_one_street(spark):
    rng = np.random.default_rng(2)
    spread = [(i, float(rng.uniform(50, 60)), float(rng.uniform(30, 60))) for i in range(200)]
    copies = [(1000 + i, 55.75, 37.61) for i in range(200)]
    street = [(2000 + i, 55.75 + float(rng.uniform(0, 1e-4)), 37.62 + float(rng.uniform(0, 1e-4))) for i in range(200)]
    data = spread + copies + street
    check(spark, data, 6, tile_rows=64, leaf_spots=8)
    check(spark, data, 6, include_self=False, tile_rows=64, leaf_spots=8)


def test_points_within_a_finest_curve_cell(spark):
    rng = np.random.default_rng(3)
    check(spark, [(i, 1e-6 * float(rng.uniform()), 1e-6 * float(rng.uniform())) for i in range(150)], 5, tile_rows=32)


def test_grid_of_ties(spark):
    check(spark, [(i * 10 + j, float(i), float(j)) for i in range(10) for j in range(10)], 5, tile_rows=16, leaf_spots=4)


def test_fewer_points_than_k(spark):
    data = [(1, 10.0, 10.0), (2, 10.0, 11.0), (3, -80.0, 170.0)]
    check(spark, data, 5)
    check(spark, data, 5, include_self=False)
    check(spark, data[:1], 3)
    assert rows(knn.knn_pairs(spark.createDataFrame([], SCHEMA), 3)) == []


def test_own_point_and_symmetry(spark):
    data = sphere(np.random.default_rng(4), 120)
    got = rows(knn.knn_pairs(spark.createDataFrame(data, SCHEMA), 4, tile_rows=32))
    km = {(a, b): d for a, b, _, d in got}
    assert all(km[(i, i)] == 0.0 for i, _, _ in data)
    assert all(km[(a, b)] == pytest.approx(km[(b, a)], abs=2e-6) for a, b in km if (b, a) in km)


def test_k_must_be_positive(spark):
    with pytest.raises(ValueError, match="positive"):
        knn.knn_pairs(spark.createDataFrame([], SCHEMA), 0)


def test_wide_and_back(spark):
    pairs = knn.knn_pairs(spark.createDataFrame(sphere(np.random.default_rng(5), 30), SCHEMA), 3)
    long = rows(knn.wide_to_long(knn.long_to_wide(pairs)))
    assert long == sorted((a, b, n - 1, d) for a, b, n, d in rows(pairs))


def test_only_equi_joins(spark):
    pairs = knn.knn_pairs(spark.createDataFrame(sphere(np.random.default_rng(6), 50), SCHEMA), 3)
    text = plan(pairs)
    assert "WindowGroupLimit" in text
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in text


def test_no_reach_is_the_whole_sphere(spark):
    """Also where a tile has fewer spots than are wanted; tiles borrow from their neighbours."""
    data = spark.createDataFrame(sphere(np.random.default_rng(7), 600), SCHEMA)
    spots = knn._leaves(knn._spots(data, 40), 40, 16, 8)
    assert spots.where("reach2 >= 3.9").count() == 0
    check(spark, sphere(np.random.default_rng(7), 600), 40, tile_rows=16, leaf_spots=8)


def test_leaves_are_small_and_disjoint(spark):
    rng = np.random.default_rng(8)
    town = [(i, 55.75 + float(rng.normal(0, 0.01)), 37.6 + float(rng.normal(0, 0.01))) for i in range(3000)]
    data = spark.createDataFrame(town + sphere(rng, 300, 5000), SCHEMA)
    leaves = knn._leaves(knn._spots(data, 5), 5, 256, 16)
    cells = {(r["node"], r["level"]): r["n"] for r in leaves.groupBy("node", "level").agg(F.count("*").alias("n")).collect()}
    assert max(cells.values()) <= 16 and sum(cells.values()) == 3300
    nodes = {n for n, _ in cells}
    assert not any(n >> 3 * up in nodes for n, level in cells for up in range(1, level))


@pytest.mark.parametrize("town", [2000, 8000])
def test_a_metropolis_and_isolated_points(spark, town):
    """What a spot visits is bounded by a constant, whatever the size of the town beside it."""
    rng = np.random.default_rng(town)
    inside = [(i, 55.75 + float(rng.normal(0, 0.02)), 37.6 + float(rng.normal(0, 0.02))) for i in range(town)]
    alone = sphere(rng, 200, 100_000)
    points = spark.createDataFrame(inside + alone, SCHEMA)
    data = materialise(knn._leaves(knn._spots(points, 5), 5, 512, 16), "test-spots")
    tree = materialise(knn._tree(data), "test-tree")
    rows = data.select("spot", "lat", "lon", *knn.AXES, "reach2", F.lit(4.0).alias("max2"), F.lit(0.0).alias("min2"), F.lit(0).cast("bigint").alias("n"),
                       knn._above(F.col("node"), F.col("level")).alias("node"), F.lit(0).cast("bigint").alias("part"), F.lit(True).alias("open"))
    for _ in range(0, tree.agg(F.max("level")).first()[0], knn.STRIDE):
        rows = knn._descend(rows, tree, 5)
    visits = rows.groupBy("spot").agg(F.count("*").alias("leaves"), F.sum("n").alias("spots")).agg(F.max("leaves"), F.max("spots"), F.avg("spots")).first()
    assert visits[0] <= 40 and visits[1] <= 400 and visits[2] <= 120
    if town == 2000:
        check(spark, inside + alone, 5, tile_rows=512, leaf_spots=16)
