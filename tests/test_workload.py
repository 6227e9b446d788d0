"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import duckdb
import pytest
from helpers import plan

import __spark_entry__ as contract
from workload.oracles import ORACLES
from workload.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    yield connection
    connection.close()


def table_rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    tidy = [[round(row[i], 9) if isinstance(row[i], float) else row[i] for i in order] for row in data]
    return sorted(tidy, key=repr)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, SMALL)
    physical = plan(got)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert bad not in physical
    cursor = duck.execute(contract.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(got.columns) == sorted(names)
    want = table_rows(names, cursor.fetchall())
    assert want, "the query finds nothing in this data"
    assert table_rows(got.columns, got.collect()) == want


def test_entry(spark):
    assert contract.entry(spark).count() == 577
