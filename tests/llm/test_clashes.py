"""Operators and stages that pass columns through: clashing names, odd rows, empty tables."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from forecourt.llm import decontaminate, language, minhash, mixing, secrets
from forecourt.session import materialise, run_folder

NAMES = ["copies", "kept", "kept_id", "letters", "row", "id", "id_", "of", "text_key", "times", "row_key", "digest", "component", "component_id",
         "n", "h", "size", "source_", "target", "chance", "cell", "a.b", "sp ace", "__key", "runs", "label"]
TEXTS = [
    (1, "one two three four five six seven eight nine ten", "en", "a"), (2, "one two three four five six seven eight nine ten", "en", "b"),
    (3, None, "en", "a"), (4, "", None, None), (5, "password = hunter2hunter2x and more words here", "en", "a"), (None, "no id but words", "en", None),
    (None, "no id but words", "en", None), (7, "same id, first text of the two", "de", "b"), (7, "same id, another text of the two", "de", "b"), (7, "same id, another text of the two", "de", "b"),
    (8, "the item that must not be seen in any document at all", "en", "a"), (9, "1 2 3", "xx", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*t, None if t[1] is None else len(t[1]), *[f"{c}{i}" for c in NAMES]) for i, t in enumerate(TEXTS)]
    extra = ", ".join(f"`{c}` string" for c in NAMES)
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "the item that must not be seen in any document at all")], "item_id bigint, text string")


def operators(docs, items):
    net = language.learn(docs)
    return {
        "language": lambda d: language.of_known_language(d, net, 0.0),
        "near_duplicates": minhash.one_of_each,
        "decontaminate": lambda d: decontaminate.without_leaks(d, items),
        "secrets": secrets.redact,
        "mix": mixing.mixed,
    }


def test_columns_of_any_name_pass_through(docs, items):
    for name, apply in operators(docs, items).items():
        out = apply(docs)
        want = [*[c for c in docs.columns if c != "copies"], "copies"] if name == "mix" else docs.columns
        assert out.columns == want
        got = {r["a.b"]: r for r in out.collect()}
        assert got, name
        for i, (doc_id, text, *_) in enumerate(TEXTS):
            if f"a.b{i}" in got:
                row = got[f"a.b{i}"]
                assert all(row[c] == f"{c}{i}" for c in NAMES if c != "copies") and row["doc_id"] == doc_id
                assert row["text"] == text or name == "secrets"
        if name == "mix":
            assert all(r["copies"] in (1, 2) for r in got.values())


def test_one_row_of_each_id_stays(docs):
    left = [(r["doc_id"], r["text"]) for r in minhash.one_of_each(docs).collect()]
    assert sorted(i for i, _ in left if i) == [1, 3, 4, 5, 7, 8, 9]
    assert dict((i, t) for i, t in left if i == 7) == {7: "same id, another text of the two"}
    assert sum(i is None for i, _ in left) == 2
    assert sorted(left, key=repr) == sorted(((r["doc_id"], r["text"]) for r in minhash.one_of_each(docs.repartition(5)).collect()), key=repr)


@pytest.mark.parametrize("rows", ["all", "none"])
def test_stages_on_odd_tables(spark, tmp_path, docs, items, rows):
    frame = docs if rows == "all" else docs.limit(0)
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    with run_folder(spark):
        now = spark.read.parquet(str(tmp_path / "documents.parquet"))
        for name, stage in corpus_pipeline.STAGES:
            before = now.columns
            now = materialise(stage(spark, now, str(tmp_path)), f"test-{name}")
            assert now.columns == (before if name != "mix" else [*[c for c in before if c != "copies"], "copies"])
        out = corpus_pipeline.run(spark, str(tmp_path)).collect()
        assert sorted(map(repr, out)) == sorted(map(repr, now.collect()))
    if rows == "none":
        assert out == []
    else:
        assert all(r["text"] and "hunter2" not in r["text"] and r["doc_id"] != 8 for r in out)
        assert len({r["doc_id"] for r in out if r["doc_id"]}) == sum(r["doc_id"] is not None for r in out)


def test_a_run_removes_its_folder(spark, tmp_path, monkeypatch):
    from forecourt import session

    base = tmp_path / "base"
    base.mkdir()
    session.remove_runs(spark)
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(base))
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert len(os.listdir(base)) == 1
    session.remove_runs(spark)
    assert os.listdir(base) == []
