"""The registered queries over a small table against plain versions."""

from __future__ import annotations

import zlib
from collections import defaultdict

import brute
import pyarrow.parquet as pq
import pytest
from pyspark.sql.types import LongType, StructField, StructType

import __spark_entry__ as contract
import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return {n: pq.read_table(f"{SMALL}/{n}.parquet").to_pylist() for n in ("documents", "benchmark", "conversations", "labels", "embeddings")}


@pytest.fixture(scope="module")
def texts(tables):
    return [(r["doc_id"], r["text"]) for r in tables["documents"]]


def result(spark, name):
    return contract.queries()[name](spark, SMALL).collect()


def test_all_are_registered():
    names = contract.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))


def test_toxicity(spark, tables):
    rows = result(spark, "op1_toxicity")
    assert len(rows) == len(tables["documents"])
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_toxicity_is_found_in_held_out_documents(spark):
    """Half of what the labels hold is learned from at this size; every language with labels."""
    sf = "/root/testdata/sf0.1"
    label = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    lang = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "lang"]).to_pylist()}
    rows = [r for r in contract.queries()["op1_toxicity"](spark, sf).collect() if r["held_out"] and r["doc_id"] in label]
    found = [label[r["doc_id"]] for r in rows if r["predicted"]]
    toxic = [r for r in rows if label[r["doc_id"]]]
    assert sum(found) >= 0.9 * len(toxic) and sum(found) >= 0.85 * len(found)
    for name in {lang[r["doc_id"]] for r in toxic}:
        own = [r["predicted"] for r in toxic if lang[r["doc_id"]] == name]
        assert sum(own) > 0.6 * len(own)


def test_vectors(spark, tables):
    want = brute.near_vectors([(r["vec_id"], r["embedding"], r["label"]) for r in tables["embeddings"]], 0.93)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in result(spark, "op2_sphere")} == want


def test_mixing(spark, tables):
    rows = result(spark, "op3_mixing")
    sizes, taken = defaultdict(int), defaultdict(int)
    source, size = {}, {}
    for r in tables["documents"]:
        source[r["doc_id"]], size[r["doc_id"]] = r["source"], len(brute.words(r["text"]))
        sizes[r["source"]] += size[r["doc_id"]]
    want = brute.targets(sizes)
    assert len(rows) == len(size)
    for r in rows:
        name = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], sizes[name])
        assert r["target"] == pytest.approx(want[name])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[name] += r["taken"]
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.01)
    assert all(abs(taken[s] - want[s]) <= 0.05 * sizes[s] for s in sizes)
    assert sorted(rows) == sorted(result(spark, "op3_mixing"))


def test_chat(spark, tables):
    turns = defaultdict(list)
    for r in sorted(tables["conversations"], key=lambda r: r["turn"]):
        turns[r["conv_id"]].append((r["role"], r["text"] or ""))
    turns[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    rows = {r["conv_id"]: r for r in result(spark, "op4_chat")}
    assert rows.keys() == turns.keys()
    for conv, said in turns.items():
        trained = "".join(t for role, t in said if role == "assistant")
        r = rows[conv]
        assert r["turns_sha256"] == brute.sha("".join(f"{role}\n{t}\n" for role, t in said))
        assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (len(said), len(trained), brute.sha(trained))


def test_minhash(spark, texts):
    want = brute.near_duplicates(texts, 3, 85)
    rows = result(spark, "op5_minhash")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_suffixes(spark, texts):
    rows = result(spark, "op6_suffixes")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert got == brute.removed(texts, 100)


def test_decontamination(spark, tables, texts):
    items = [(r["item_id"], r["text"]) for r in tables["benchmark"]]
    got = {(r["doc_id"], r["item_id"]) for r in result(spark, "op7_decontamination")}
    assert got == brute.leaks(texts, items, 5, 0.8) != set()


def test_secrets(spark, texts):
    rows = {r["doc_id"]: r for r in result(spark, "op8_secrets")}
    for doc_id, text in texts:
        base = brute.secrets(text)
        assert rows[doc_id]["base_sha256"] == brute.sha(brute.spelled(base))
        assert set(map(str, brute.spelled(base).split(","))) <= {*rows[doc_id]["spans"].split(","), ""}


def test_personal_data(spark, texts):
    rows = {r["doc_id"]: r for r in result(spark, "op9_pii")}
    for doc_id, text in texts:
        base = brute.spelled(brute.personal(text))
        assert rows[doc_id]["base_sha256"] == brute.sha(base)
        assert rows[doc_id]["spans"].startswith(base)
    plan = contract.queries()["op9_pii"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_language(spark, tables):
    lang = {r["doc_id"]: r["lang"] for r in tables["documents"]}
    rows = result(spark, "op10_language")
    assert len(rows) == len(lang)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_pipeline_stages(spark, tables):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect() or [], stage_schema(docs, name))
        seen.append(docs)
    assert all(d.columns == columns for d in seen[:-1])
    before, kept, single, clean, masked, mixed = ([(r["doc_id"], r["text"]) for r in d.collect()] for d in seen)
    assert len(kept) >= 0.98 * len(before)
    of = brute.near_duplicates(kept, 5, 80)
    assert {i for i, _ in single} == {i for i, (_, c) in of.items() if i == c}
    leaked = {i for i, _ in brute.leaks(single, [(r["item_id"], r["text"]) for r in tables["benchmark"]], 5, 0.8)}
    assert {i for i, _ in clean} == {i for i, _ in single} - leaked
    assert {i for i, _ in masked} == {i for i, _ in clean}
    assert not any(brute.secrets(t) for _, t in masked)
    assert {i for i, _ in mixed} <= {i for i, _ in masked}
    assert all(r["copies"] in (1, 2) for r in seen[-1].collect())


def stage_schema(docs, name):
    return StructType([*docs.schema, StructField("copies", LongType())]) if name == "mix" else docs.schema
