"""Importance resampling: buckets, gains, noise, the k-th key, ranks."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as contract
from forecourt.llm import common, resample

SMALL = "/root/testdata/sf0.001"
KIND = "doc_id bigint, text string, score string, rank string, row string, part int"
ODD = ["", None, " ", "one", "One two TWO", "é É ß\u3000x", "a_b-c.d", "x" * 300 + " y", "0 1 2 " * 30, "\U0001f600a\x00b", "long" * 400_000 + " tail of it", "w1 w2 " * 200_000]


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [zlib.crc32(w.encode()) % 10000 for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]


def plain(docs, target, percent=10, least=20):
    """Rows (doc_id, n_features, weight, score, rank), sorted; ids differ or are null."""
    own = [features(t) for _, t in docs]
    s, t = Counter(b for f in own for b in f), Counter(b for x in target for b in features(x))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10000) / ((s[b] + 1.0) * (big_t + 10000)))) for b in range(10000)]
    rows = []
    for (doc_id, _), f in zip(docs, own, strict=True):
        weight, score = sum(gain[b] for b in f), None
        if doc_id is not None:
            h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(f), weight, score))
    able = sorted((r for r in rows if r[0] is not None and r[1] >= least), key=lambda r: (-r[3], r[0]))
    rank = {r[0]: i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted(((*r, rank.get(r[0])) for r in rows), key=repr)


def drawn(spark, docs, target, **more):
    frame = spark.createDataFrame([(i, t, "s", "r", "w", 1) for i, t in docs], KIND)
    out = resample.resample(frame, spark.createDataFrame([(t, 1) for t in target], "text string, bucket int"), **more)
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_query(spark):
    docs, items = (pq.read_table(f"{SMALL}/{n}.parquet").to_pydict() for n in ("documents", "benchmark"))
    frame = contract.queries()["op13_resampling"](spark, SMALL)
    assert {k for _, k in frame.dtypes} == {"bigint"}
    want = plain(list(zip(docs["doc_id"], docs["text"], strict=True)), items["text"])
    assert sorted((tuple(r) for r in frame.collect()), key=repr) == want and sum(r[4] is not None for r in want) > 5


def test_odd_texts(spark):
    docs = [*enumerate(ODD), *((100 + i, f"word{i % 9} " * (i % 40)) for i in range(200)), (None, "null id " * 20)]
    target = ["word1 word2", None, "", "é w1"]
    assert drawn(spark, docs, target) == plain(docs, target)


@given(st.lists(st.text(alphabet="aZ09_é \U0001f600-\n", max_size=60), max_size=6), st.integers(1, 40))
@settings(max_examples=150, deadline=None)
def test_words_in_chunks_of_any_size(texts, size):
    data, bounds = common.buffers(pa.array(texts, pa.string()))
    want = [sorted(features(t)) for t in texts]
    got = [[] for _ in texts]
    for first, last, part, within, _ in common.chunks(data, bounds, ~resample._IN_WORD, size):
        for row in range(first, last):
            got[row] += resample.word_buckets(part[within[row - first] : within[row - first + 1]])[1].tolist()
    assert [sorted(g) for g in got] == want


@pytest.mark.parametrize("percent", [0, 1, 50, 100])
def test_shares(spark, percent):
    docs = [(i, f"a{i % 5} b c " * 8) for i in range(60)]
    assert drawn(spark, docs, ["a1 a2 b"], percent=percent) == plain(docs, ["a1 a2 b"], percent)


def test_empty_tables(spark):
    assert drawn(spark, [], ["a"]) == []
    docs = [(1, "a b " * 20), (2, None)] + [(i, "c " * 20) for i in range(3, 20)]
    assert drawn(spark, docs, []) == plain(docs, [])


def test_repeated_rows_are_drawn_apart(spark):
    got = drawn(spark, [(7, "a b " * 20)] * 30 + [(None, "a b " * 20)] * 5, ["a"])
    assert Counter(r[0] for r in got) == {7: 30, None: 5}
    assert sorted(r[4] for r in got if r[4]) == [1, 2, 3] and all(r[3] is None and r[4] is None for r in got if r[0] is None)


@pytest.mark.parametrize("pivots", [1, 3, 24])
def test_kth_key(spark, pivots):
    rng = np.random.default_rng(pivots)
    keys = [(int(s), int(d), r) for r, (s, d) in enumerate(zip(rng.integers(0, 4, 90), rng.integers(0, 5, 90), strict=True))]
    frame = spark.createDataFrame(keys, "score bigint, doc_id bigint, row bigint")
    order = sorted(keys, key=lambda k: (-k[0], k[1], k[2]))
    for k in (1, 45, 90):
        assert resample.kth_key(frame, k, pivots) == order[k - 1]


def test_ranks_over_several_partitions(spark):
    frame = spark.range(1, 2001).selectExpr("id as row", "id % 7 as score", "id % 50 as doc_id")
    rows = sorted(resample.ranked(frame).collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == list(range(1, 2001))
    assert [(-r["score"], r["doc_id"], r["row"]) for r in rows] == sorted((-(i % 7), i % 50, i) for i in range(1, 2001))
