from __future__ import annotations

import json

import pytest
from helpers import plan, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from forecourt import session
from forecourt.operators import registry
from forecourt.plans import enrichment
from forecourt.sources import readers, sinks
from workload.queries import QUERIES


def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:x", query="SELECT 1")
    assert plain == {"url": "jdbc:x", "fetchsize": "10000", "query": "SELECT 1"}
    ranged = readers.jdbc_options(
        "jdbc:x", query="SELECT 1", partition_column="station_id", bounds=(0, 99), partitions=4,
        properties={"user": "u", "fetchsize": "5"},
    )
    assert ranged == {
        "url": "jdbc:x",
        "fetchsize": "5",
        "user": "u",
        "dbtable": "(SELECT 1) AS t",
        "partitionColumn": "station_id",
        "lowerBound": "0",
        "upperBound": "99",
        "numPartitions": "4",
    }
    assert readers.jdbc_options("jdbc:x", table="t")["dbtable"] == "t"
    for wrong in ({}, {"table": "t", "query": "q"}, {"table": "t", "partition_column": "c"}):
        with pytest.raises(ValueError):
            readers.jdbc_options("jdbc:x", **wrong)


def test_ids_keep_blanks(spark, tmp_path):
    (tmp_path / "ids.txt").write_bytes(b" 1 \n\n2\n2")
    assert rows(readers.read_ids(spark, str(tmp_path / "ids.txt"))) == [("",), (" 1 ",), ("2",), ("2",)]


BROKEN = ["x;1;1", "2;x;1", "3;1", "3;1;2;4", ";1;2", "4;;1", "5;NaN;1", "6;1;Infinity", "7;90.5;1", "8;1;181", "", "9"]


def test_points_file(spark, tmp_path):
    good = ["1;55.5;37.5", "10;-90;180"]
    (tmp_path / "points.csv").write_text("\n".join([good[0], *BROKEN, good[1]]) + "\n", encoding="utf-8")
    path = str(tmp_path / "points.csv")
    found = rows(readers.scan_points(spark, path).where("broken is null"))
    assert found == [(1, 55.5, 37.5, None), (10, -90.0, 180.0, None)]
    lost = readers.scan_points(spark, path).where("broken is not null").collect()
    assert sorted(r["broken"] for r in lost) == sorted(BROKEN) and all(r["id"] is r["lat"] is r["lon"] is None for r in lost)
    counts = Observation("points")
    points = readers.read_points(spark, path, counts)
    assert rows(points) == [(1, 55.5, 37.5), (10, -90.0, 180.0)]
    assert counts.get == {"lines": 14, "broken": len(BROKEN)}
    assert plan(points).split("== Initial Plan ==")[0].count("FileScan text") == 1


def test_counts_come_from_the_same_pass(spark, tmp_path):
    payloads = [("1", "[]", 1), ("2", "[{", 1), ("3", None, 1), ("4", '[{"value":"x"}]', 1)]
    spark.createDataFrame(payloads, "itn STRING, payload STRING, loaded BIGINT").write.parquet(str(tmp_path / "registry"))
    ids = spark.createDataFrame([(str(i),) for i in range(1, 7)], "itn STRING")
    counts = Observation("records")
    table = enrichment.company_table(ids, spark.read.parquet(str(tmp_path / "registry")), "null", counts)
    assert {r["itn"]: r["name"] for r in table.collect()} == {"1": "", "2": "", "3": "", "4": "x", "5": "", "6": ""}
    assert counts.get == {"ids": 6, "missing": 3, "malformed": 1}
    assert plan(table).split("== Initial Plan ==")[0].count("FileScan parquet") == 1


def test_the_last_record_loaded_counts(spark):
    kind = "itn STRING, payload STRING, loaded BIGINT"
    records = spark.createDataFrame([("1", "z", 1), ("1", "a", 2), ("2", "b", 5), ("2", "c", 5), ("3", "y", None), ("3", "b", 0), ("4", "x", None), ("4", None, 7)], kind)
    ids = spark.createDataFrame([(i,) for i in "12345"], "itn STRING")
    want = {"1": "a", "2": "c", "3": "b", "4": None, "5": None}
    assert dict(map(tuple, registry.registry_lookup(ids, records).collect())) == want
    assert dict(map(tuple, registry.registry_lookup(ids, records.repartition(7)).collect())) == want
    by_text = registry.registry_lookup(ids, records.drop("loaded"))
    assert dict(map(tuple, by_text.collect())) == {"1": "z", "2": "c", "3": "y", "4": "x", "5": None}


@pytest.mark.parametrize(
    ("phones", "text"),
    [('["1", "2"]', "1, 2"), ("[]", ""), ("null", None), ('"1"', "1"), ("7", "7"), ('[{"value":"1"},{"kind":"x"},{"value":null},null,5,true]', "1, 5, true"), ('[["1"]]', '["1"]')],
)
def test_lists_give_a_text(spark, phones, text):
    found = spark.createDataFrame([("1", f'[{{"data":{{"phones":{phones}}}}}]')], "itn STRING, payload STRING")
    assert registry.registry_flatten(found).first()["phone"] == text


def test_company_table(spark, tmp_path):
    full = [
        {
            "value": "Ромашка",
            "data": {
                "type": "LEGAL",
                "address": {"unrestricted_value": "Street"},
                "phones": ["1", "2"],
                "emails": None,
                "state": {"status": "ACTIVE", "actuality_date": 1600000000000},
                "okved": "1",
                "management": {"name": "Boss"},
            },
        }
    ]
    lines = [{"itn": "1", "payload": json.dumps(full, ensure_ascii=False)}, {"itn": "2", "payload": "[]"}]
    (tmp_path / "registry.json").write_text("\n".join(map(json.dumps, lines)), encoding="utf-8")
    ids = spark.createDataFrame([("1",), ("1",), ("2",), ("3",)], "itn STRING")
    registry = readers.read_registry(spark, str(tmp_path / "registry.json"))
    path = enrichment.write_company_table(ids, registry, str(tmp_path), "run1")
    assert path.endswith("company_table_run1")
    blank = ("", None, "", "", "", None, None, "", "", "")
    got = spark.read.parquet(path)
    assert got.columns == (
        "itn name type address phone email status_itn updated_date okved kpp full_name_director".split()
    )
    assert sorted(map(tuple, got.collect())) == [
        ("1", "Ромашка", "ЮЛ", "Street", "1, 2", None, "действующая", "2020-09-13 12:26:40", "1", "", "Boss"),
        ("2", *blank),
        ("3", *blank),
    ]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        enrichment.write_company_table(ids, registry, str(tmp_path), "run1")


def test_unknown_codes(spark):
    ids = spark.createDataFrame([("1",)], "itn STRING")
    odd = spark.createDataFrame([("1", '[{"data":{"type":"ODD"}}]')], "itn STRING, payload STRING")
    with pytest.raises(Exception, match="unknown code: ODD"):
        enrichment.company_table(ids, odd).collect()
    assert enrichment.company_table(ids, odd, "null").first()["type"] is None


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "ы")], "a BIGINT, `b, c` STRING")
    for _ in range(2):
        sinks.write_table(df, str(tmp_path / "csv"), "csv")
    assert rows(spark.read.csv(str(tmp_path / "csv"), header=True)) == [("1", "ы")]
    sinks.write_table(df, str(tmp_path / "parquet"))
    assert rows(spark.read.parquet(str(tmp_path / "parquet"))) == [(1, "ы")]


def test_a_table_can_replace_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(10), path)
    kept = spark.read.parquet(path).where("id >= 4")
    sinks.write_table(kept, path + "/")
    assert rows(spark.read.parquet(path)) == [(i,) for i in range(4, 10)]
    assert [f.name for f in tmp_path.iterdir()] == ["t"]


def test_a_job_that_fails_half_way_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(10), path)
    failing = spark.range(0, 100, 1, 8).select(F.when(F.col("id") == 99, F.raise_error(F.lit("half way")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="half way"):
        sinks.write_table(failing, path)
    assert rows(spark.read.parquet(path)) == [(i,) for i in range(10)]
    assert [f.name for f in tmp_path.iterdir()] == ["t"]


def test_a_run_that_failed_can_be_run_again(spark, tmp_path):
    failing = spark.range(0, 100, 1, 8).select(F.when(F.col("id") == 99, F.raise_error(F.lit("half way")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="half way"):
        sinks.write_run(failing, str(tmp_path), "t", "7")
    assert list(tmp_path.iterdir()) == []
    path = sinks.write_run(spark.range(3), str(tmp_path), "t", "7")
    with pytest.raises(FileExistsError):
        sinks.write_run(spark.range(4), str(tmp_path), "t", "7")
    sinks.write_table(spark.range(3, 5), path, mode="append")
    assert rows(spark.read.parquet(path)) == [(i,) for i in range(5)]
    with pytest.raises(ValueError):
        sinks.write_table(spark.range(1), path, mode="ignore")


def test_an_interrupted_swap_is_finished(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(3), path)
    (tmp_path / "t").rename(tmp_path / "t.old-1")
    sinks.restore_table(spark, path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,)]
    spark.range(9).write.parquet(f"{path}.old-2")  # not removed after a swap
    sinks.write_table(spark.read.parquet(path).where("id > 0"), path)
    assert rows(spark.read.parquet(path)) == [(1,), (2,)] and [f.name for f in tmp_path.iterdir()] == ["t"]


def test_intermediate_tables_go_to_the_named_folder(spark):
    folder = session.shared_folder(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or folder == named
    df = session.materialise(spark.range(3).toDF("a"), "t")
    assert rows(df) == [(0,), (1,), (2,)]
    assert folder in df.inputFiles()[0]


def test_a_run_leaves_nothing(spark, tmp_path, monkeypatch):
    base = tmp_path / "base"
    base.mkdir()
    session.remove_runs(spark)
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(base))
    with session.run_folder(spark) as folder:
        with session.run_folder(spark, keep=True) as inner:
            assert inner == folder
        assert rows(session.materialise(spark.range(2), "t")) == [(0,), (1,)]
        assert len(list(base.iterdir())) == 1
    assert list(base.iterdir()) == []
    for name in ("nearest_competitors", "apply_changes", "registry_sink", "id_list"):
        QUERIES[name](spark, "/root/testdata/sf0.001").count()
    with pytest.raises(ZeroDivisionError), session.run_folder(spark, keep=True):
        session.materialise(spark.range(2), "t")
        1 / 0
    assert len(list(base.iterdir())) == 5
    session.remove_runs(spark)
    assert list(base.iterdir()) == []
