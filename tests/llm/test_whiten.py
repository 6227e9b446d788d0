"""Whitening by Jacobi-Davidson against a dense eigensolver."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as contract
from forecourt.llm import whiten

SMALL = "/root/testdata/sf0.001"
KIND = "vec_id bigint, embedding array<double>, component int, x string, n int"


def dense(vectors, components=8):
    """n, exact deviations, absolute whitened coordinates, explained parts."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    y = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in x])
    cov = y.T @ y / n
    values, u = np.linalg.eigh(cov)
    values, u = values[::-1][:components], u[:, ::-1][:, :components]
    some = values > 1e-13 * values[0]
    values, u = values[some], u[:, some]
    return n, [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x], y @ u / np.sqrt(values), values / np.trace(cov)


def check(rows, ids, vectors, components=8, near=1e-8):
    n, deviation, whitened, explained = dense(vectors, components)
    assert len(rows) == len(ids) * len(explained)
    by = defaultdict(list)
    for r in rows:
        assert r["n"] == n and r["identity_error"] <= 1e-4
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
        by[r["component"]].append((r["vec_id"], int(r["deviation"]), r["whitened"]))
    for k, mine in by.items():
        want = list(zip(ids, deviation, whitened[:, k - 1], strict=True))
        sign = max((1, -1), key=lambda s: sum(s * a[2] * b[2] for a, b in zip(sorted(mine), sorted(want), strict=True)))
        for a, b in zip(sorted(mine), sorted((i, d, sign * w) for i, d, w in want), strict=True):
            assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=near)


def run(spark, vectors, **more):
    return whiten.whiten(spark.createDataFrame([(i, v, 1, "x", 2) for i, v in vectors], KIND), **more).collect()


def test_query(spark):
    t = pq.read_table(f"{SMALL}/embeddings.parquet").to_pydict()
    frame = contract.queries()["op12_whitening"](spark, SMALL)
    assert dict(frame.dtypes)["deviation"] == "bigint"
    check(frame.collect(), t["vec_id"], t["embedding"])


@pytest.mark.parametrize(("rows", "length", "components"), [(40, 3, 8), (300, 40, 8), (9, 20, 8), (60, 12, 2), (5, 1, 8)])
def test_against_dense(spark, rows, length, components):
    rng = np.random.default_rng(length)
    vectors = (rng.normal(size=(rows, length)) * np.linspace(1, 9, length)).tolist()
    check(run(spark, list(enumerate(vectors)), components=components), list(range(rows)), vectors, components)


def test_what_is_dropped(spark):
    rng = np.random.default_rng(1)
    good = rng.normal(size=(30, 4)).tolist()
    odd = [None, [], [1.0, None, 2.0, 3.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0], [2.0**53, 0.0, 0.0, 0.0]]
    got = run(spark, [*enumerate(good), *((100 + i, v) for i, v in enumerate(odd))])
    check(got, list(range(30)), good)


def test_repeated_and_missing_ids(spark):
    rng = np.random.default_rng(2)
    some = rng.normal(size=(6, 3)).tolist()
    got = run(spark, [(1, some[0]), (1, some[0]), (None, some[1]), (None, some[1]), *((i, v) for i, v in enumerate(some, 10))])
    assert len(got) == 10 * 3
    same = {(r["component"], r["deviation"], r["whitened"]) for r in got if r["vec_id"] in (1, 10)}
    assert len(same) == 3


def test_tables_without_variance(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0, 2.0])]) == []
    assert run(spark, [(i, [1.0, 2.0]) for i in range(5)]) == []
    assert run(spark, [(1, None)]) == []


def test_equal_eigenvalues_and_missing_rank(spark):
    corners = [(8 * i + j, [float(a), float(b), float(c), 7.0]) for i in range(3) for j, (a, b, c) in enumerate(np.ndindex(2, 2, 2))]
    got = run(spark, corners)
    assert {r["component"] for r in got} == {1, 2, 3}
    assert all(r["explained"] == pytest.approx(1 / 3) and r["identity_error"] < 1e-9 for r in got)


def test_large_numbers_stay_exact(spark):
    vectors = [[float(i * i) * 2.0**30, 1.0 / (i + 1)] for i in range(12)]
    got = run(spark, list(enumerate(vectors)))
    want = dense(vectors)[1]
    assert {(r["vec_id"], int(r["deviation"])) for r in got} == set(enumerate(want)) and max(want) > 2**63


def test_more_rows_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(whiten, "BLOCK", 7)
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(100, 5)).tolist()
    check(run(spark, list(enumerate(vectors))), list(range(100)), vectors)


def test_inner_solver_solves():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(30, 30))
    a = a @ a.T
    base = np.linalg.qr(rng.normal(size=(30, 2)))[0]
    right = rng.normal(size=(30, 3))
    shift = np.array([1.0, 20.0, 40.0])
    t = whiten.minres(lambda u: a @ u, shift, base, right, np.full(3, 1e-13), 80)
    project = np.eye(30) - base @ base.T
    assert np.abs(project @ (a @ t - t * shift) - project @ right).max() < 1e-7
    assert np.abs(base.T @ t).max() < 1e-12


def test_eigenpairs_reach_double_precision():
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(120, 120)))[0]
    values = np.concatenate(([50.0, 50.0, 49.9999], np.linspace(30, 0, 117)))
    a = (q * values) @ q.T
    found, u = whiten.eigenpairs(lambda v: a @ v, 120, 8)
    assert np.abs(found - values[:8]).max() < 1e-12 * 50
    assert np.linalg.norm(a @ u - u * found, axis=0).max() < 1e-13 * 50
    assert np.abs(u.T @ u - np.eye(8)).max() < 1e-13
