"""Nulls, empty and odd texts, ties, repeated rows, other columns, empty tables."""

from __future__ import annotations

import time

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt.llm import chat, common, components, decontaminate, language, minhash, mixing, pii, secrets, sphere, suffixes, toxicity

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, h string, n bigint"
LONG = " ".join(f"word{i % 997}x{i}" for i in range(30_000))
COMMON = "one passage that many of the documents share, long enough to be found: " * 2
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog today and tomorrow"), (2, "the QUICK brown fox jumps over the lazy dog today and tomorrow"),
    (3, ""), (4, None), (5, " \t\n\r\x0b\x0c "), (6, "one"), (7, "One"), (8, "two words"), (9, COMMON + "first"), (10, "second " + COMMON),
    (11, LONG), (12, LONG + " more"), (13, "é" * 300), (14, "aaaa" * 200), (15, "x\u3000y \U0001f600 z"), (16, "1.2.3.4 +1 (555) 010-9999 a@b.co"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "b" if i % 3 else None, 0, 7, "h", 1) for i, t in TEXTS]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nobody(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def repeated(spark):
    return spark.createDataFrame([(None, "a b c d e f", None, None, None, 0, "", 0)] * 2 + [(5, "a b c d e f", None, None, None, 0, "", 0)] * 2, DOCS)


def test_words_and_shingles():
    texts = [t for _, t in TEXTS if t != LONG]
    data, bounds = common.buffers(pa.array(texts, pa.string()))
    got, at = common.word_hashes(data, bounds)
    plain = [w for t in texts for w in brute.words(t)]
    assert at.tolist() == np.concatenate(([0], np.cumsum([len(brute.words(t)) for t in texts]))).tolist()
    names = dict(zip(plain, got.tolist(), strict=True))
    assert [names[w] for w in plain] == got.tolist() and len(set(names.values())) == len(names)
    for k in (1, 3, 5):
        grams, where = common.shingle_hashes(got, at, k)
        assert [len(set(grams[a:b].tolist())) for a, b in zip(where, where[1:], strict=False)] == [len(brute.shingles(t, k)) for t in texts]


@pytest.mark.parametrize("size", [40, 1000])
def test_long_texts_in_chunks(spark, monkeypatch, size):
    """Texts longer than a chunk give what they give as a whole."""
    monkeypatch.setattr(common, "PIECE_BYTES", size)
    rng = np.random.default_rng(size)
    line = "a line of some words that comes again and again in the long ones, of a hundred bytes and some more; "
    texts = [(i, " ".join(f"w{j}" for j in rng.integers(0, 300, rng.integers(0, 400))) + (" " + line * (i % 3)) + "é" * (i % 50)) for i in range(30)]
    texts += [(100 + i, t + " one more word") for i, t in texts] + [(200, "x" * 3000), (201, "y " + "x" * 3000), (202, ""), (203, None)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(frame, 3, 85).collect()}
    assert got == brute.near_duplicates(texts, 3, 85)
    assert {r[0]: tuple(r)[1:] for r in suffixes.without_repeats(frame).collect()} == brute.removed(texts, 100)
    items = [(1, " ".join(texts[5][1].split()[3:25])), (2, line.strip())]
    found = decontaminate.leaked_items(frame, spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == brute.leaks(texts, items, 5, 0.8)
    monkeypatch.undo()
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in texts], "doc_id bigint, toxic int")
    whole = toxicity.learn(frame, marks)
    monkeypatch.setattr(common, "PIECE_BYTES", size)
    parts = toxicity.learn(frame, marks)
    assert np.array_equal(whole[0].keys, parts[0].keys) and np.allclose(whole[0].own, parts[0].own) and np.allclose(whole[0].fit, parts[0].fit)


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 8), (3, 1), (None, 4), (20, 21), (21, 22), (22, 23), (23, 24), (24, 3)]
    got = {(r["node"], r["component"]) for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (8, 8), (9, 8), *((i, 1) for i in range(20, 25))}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80), (1, 100)])
def test_near_duplicates(spark, docs, k, percent):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs, k, percent).collect()}
    assert got == brute.near_duplicates(TEXTS, k, percent)


def test_near_duplicates_of_odd_tables(spark, nobody, repeated):
    assert minhash.near_duplicates(nobody).count() == 0
    assert minhash.one_of_each(nobody).count() == 0
    rows = minhash.near_duplicates(repeated).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in rows) == [(0, 0, True)] * 2 + [(5, 5, True)] * 2
    left = minhash.one_of_each(repeated)
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 0, 5] and left.columns == repeated.columns


def test_mixed_buckets_are_searched(spark, monkeypatch):
    """Chains whose members are no neighbours of the smallest are found, in blocks of any size."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(60):
        words = list(base)
        for j in rng.choice(120, rng.integers(0, 9), replace=False):
            words[j] = f"v{i}x{j}"
        texts.append((i, " ".join(words)))
    want = brute.near_duplicates(texts, 3, 85)
    assert 1 < len({c for _, c in want.values()}) < 60
    for block in (256, 7):
        monkeypatch.setattr(minhash, "BLOCK", block)
        got = minhash.near_duplicates(spark.createDataFrame(texts, "doc_id bigint, text string"), 3, 85).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_suffixes(spark, docs, nobody, repeated):
    got = {r[0]: tuple(r)[1:] for r in suffixes.without_repeats(docs).collect()}
    assert got == brute.removed(TEXTS, 100)
    assert suffixes.without_repeats(nobody).count() == 0
    assert {tuple(r)[1:4] for r in suffixes.without_repeats(repeated).collect()} == {(11, 0, 0)}
    twice = spark.createDataFrame([(7, "z" + COMMON), (7, "z" + COMMON), (None, "y" + COMMON)], "doc_id bigint, text string")
    rows = sorted((tuple(r) for r in suffixes.without_repeats(twice).collect()), key=lambda r: (r[0] or 0, r[2]))
    assert [r[2] for r in rows] == [0, len(COMMON), len(COMMON)]  # the null id comes first, equal positions are not earlier


@pytest.mark.parametrize("split", [2000, 2])
def test_suffixes_of_split_buckets(spark, monkeypatch, split):
    monkeypatch.setattr(suffixes, "SPLIT", split)
    rng = np.random.default_rng(5)
    line = "a line of less than a hundred bytes that is everywhere. "
    texts = [(i, "".join(rng.choice(list("abcd "), rng.integers(0, 300))) + line + (COMMON if i % 3 else "") + str(i % 4) * 150) for i in range(40)]
    got = {r[0]: tuple(r)[1:] for r in suffixes.without_repeats(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert got == brute.removed(texts, 100)


def test_leaks(spark, docs, nobody, repeated):
    item = " ".join(LONG.split()[20_000:20_040])
    edited = item.replace(item.split()[20], "other")
    items = [(1, item), (2, edited), (3, None), (4, "too short"), (5, "fox jumps over THE lazy"), (5, "nothing of this is anywhere at all"), (6, "")]
    frame = spark.createDataFrame([(*r, 0) for r in items], "item_id bigint, text string, doc_id bigint")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaked_items(docs, frame).collect()}
    assert got == brute.leaks(TEXTS, items, 5, 0.8) == {(11, 1), (12, 1), (11, 2), (12, 2), (1, 5), (2, 5)}
    clean = decontaminate.without_leaks(docs, frame)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {i for i, _ in TEXTS} - {1, 2, 11, 12}
    assert decontaminate.leaked_items(docs, frame.limit(0)).count() == 0
    assert decontaminate.without_leaks(docs, frame.limit(0)).count() == len(TEXTS)
    assert decontaminate.leaked_items(nobody, frame).count() == 0
    assert decontaminate.without_leaks(repeated, frame).count() == 4


def test_items_in_several_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)
    items = [(i, " ".join(LONG.split()[i * 100 : i * 100 + 12 + i])) for i in range(9)]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaked_items(docs, frame).collect()}
    assert got == {(d, i) for d in (11, 12) for i in range(9)}


CODE = """
key_part = "Zq8"
db_password: 'k3yW1thSpaces'
apiToken = "abCD12" + "efGH34+/"
session_secret := ${SIGNING}
SIGNING = 'Yt6r5E4w3Q2x'
signing_key = SIGNING
color = "not-a-secret-at-all-1"
password = "your-password-here"
"""


def test_secrets(spark, docs, nobody):
    texts = [CODE, "AKIA" + "A1" * 7, "AKIA" + "A1" * 6, "ſecret=abcdefghijkl", "TOKEN:  'a.b-c/d=e+f_g1", "deadbeef" * 2 + "g" + "0" * 15, "api_key = x" * 3, None, ""]
    for text in texts + [t for _, t in TEXTS]:
        base, spans = secrets.all_spans(text or "")
        assert base == brute.secrets(text)
        assert set(base) <= set(spans)
    named = {CODE[a:b] for k, a, b in secrets.all_spans(CODE)[1] if k == "named"}
    assert {"abCD12", "efGH34+/", "Yt6r5E4w3Q2x"} <= named and not any("not-a" in n or "your" in n for n in named)
    assert "Yt6r5E4w3Q2x" not in secrets.masked(CODE) and "not-a-secret-at-all-1" in secrets.masked(CODE)
    assert secrets.find_secrets(docs).count() == len(TEXTS)
    assert secrets.find_secrets(nobody).count() == 0
    out = secrets.redact(docs)
    assert out.columns == docs.columns and {r["doc_id"]: r["text"] for r in out.collect()}[4] is None


@pytest.mark.parametrize(
    "text",
    ["signing_key" + " " * 9 + '= "Yt6r5E4w3Q2x9!"', "z" * 130 + "_signing_key = 'Yt6r5E4w3Q2x9!'", "signing_key" + "\t" * 5000 + ":" + " " * 5000 + "Yt6r5E4w3Q2x9!", "x = 'Yt6r5E4'\ny = x + 'w3Q2x9!'\nsigning_key => ${y}"],
)
def test_secrets_behind_long_names_and_gaps(text):
    assert {k for k, _, _ in secrets.all_spans(text)[1]} == {"named"}


def test_secrets_of_values_joined_over_and_over():
    first = "a = 'Zq8xT4w9Pm'\n"
    doubled = first + "a = a + a\n" * 100 + "signing_key = a\n"
    assert secrets.all_spans(doubled)[1] == [("named", 5, 15)]
    chain = first + "".join(f"a = a + 'p{i}Q'\nsigning_key = a\n" for i in range(20_000))
    assert len(secrets.all_spans(chain)[1]) == 20_001
    # a placeholder across joints
    assert secrets.all_spans("a = 'Zq8xT4change'\nb = 'me7Rw'\nsigning_key = a + b\n")[1] == []


@given(st.text(alphabet="pPaAsSwWoOrRdD_:='\" \nKIE0123456789abcdef+$(){}.", max_size=200))
@settings(max_examples=200, deadline=None)
def test_secrets_of_any_text(text):
    base, spans = secrets.all_spans(text)
    assert base == brute.secrets(text)
    assert all(0 <= a < b <= len(text) for _, a, b in spans)


PRIVATE = [
    "a@b.co, x.y+z%w@mail-1.example.org. @ no@dot a@b.c%d@e.f", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.0255.3.4 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111",
    "+1 (555) 010-9999 +1234567 +1 +12 34-", "call 555 010 9999 or mail joe [at] example [dot] org", "7 " * 40, "+" * 50, "é@b.co \U0001f600 1.1.1.1 +49 30 1234567", None, "",
    "9" * 5000, "1 " * 3000 + "a@b.co " * 300, "x" * 20_000 + "@", "1.1.1.1," * 400,
]


def test_personal_data(spark, docs, nobody):
    rows = [(i, t, "x") for i, t in enumerate(PRIVATE)]
    got = {r["doc_id"]: r for r in pii.find_personal(spark.createDataFrame(rows, "doc_id bigint, text string, m string")).collect()}
    for i, text in enumerate(PRIVATE):
        base = brute.personal(text)
        assert got[i]["base_sha256"] == brute.sha(brute.spelled(base)), text
        assert got[i]["spans"].startswith(brute.spelled(base))
        assert [got[i][f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in base) for k in pii.BASE]
        for span in filter(None, got[i]["spans"].split(",")[len(base) :]):
            kind, a, b = span.split(":")
            assert kind == "other" and all(int(b) <= s[1] or s[2] <= int(a) for s in base)
    assert pii.find_personal(docs).count() == len(TEXTS)
    assert pii.find_personal(nobody).count() == 0


def private_corpus():
    """Checked matches and failed ones in their contexts, and per document what else it should give (None: nothing)."""
    checked = ["please call +1 (555) 010-{0:04d} today", "phone: +44 20 7946 {0:04d}", "write to user{0}@mail.example.org soon", "server 10.0.{1}.{2} is down", "paid by card 4111 1111 1111 1111 then"]
    failed = ["order +12 {1:02d} was shipped", "version 300.1.{0}.999 is out", "serial 1234 5678 9012 {0:04d} of", "part +7 {2:02d} and", "order 4111 1111 1111 11{1:02d} closed"]
    extra = [("call 555 010 {0:04d} now", "555 010 {0:04d}"), ("write to joe{0} [at] example [dot] org", "joe{0} [at] example [dot] org"), ("phone: (555) 010-{0:04d}", "(555) 010-{0:04d}")]
    decoys = ["order 555 010 {0:04d} shipped", "serial 5550109{0:04d}", "version 2024 10 11 {0:04d}", "part 555-010-{0:04d}"]
    rows, want = [], {}

    def add(text, more=None):
        rows.append((len(rows), "some words before, " + text + " and after."))
        want[len(rows) - 1] = more

    for i in range(60):
        for shape in checked + failed:
            add(shape.format(i, i % 90 + 3, i % 70 + 5))
        for shape, span in extra if i % 6 == 0 else ():
            add(shape.format(i), span.format(i))
        for shape in decoys if i % 6 == 0 else ():
            add(shape.format(i))
    return rows, want


def test_personal_data_beyond_the_patterns(spark):
    rows, want = private_corpus()
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    text = dict(rows)
    got = {r["doc_id"]: r for r in pii.find_personal(frame).collect()}
    others = {i: [text[i][int(a) : int(b)] for k, a, b in (s.split(":") for s in filter(None, r["spans"].split(","))) if k == "other"] for i, r in got.items()}
    wanted = {i for i, w in want.items() if w}
    assert sum(others[i] == [want[i]] for i in wanted) >= 0.9 * len(wanted)
    assert not [others[i] for i in others if i not in wanted and others[i]]
    assert sum(r["n_other"] for r in got.values()) >= 27
    # too few matches that fail their check: nothing is added
    few = frame.where(F.col("text").rlike("please|write|call"))
    assert pii.find_personal(few).agg(F.sum("n_other")).first()[0] == 0


def test_boosting_learns_an_interaction():
    counts = [(bits, 50 if bits in (1, 2, 5, 6) else 0, 0 if bits in (1, 2, 5, 6) else 50) for bits in range(8)]
    grown = pii.boost(counts, 3)
    score = {bits: pii.tree_score(grown, bits) for bits in range(8)}
    assert min(score[b] for b in (1, 2, 5, 6)) > max(score[b] for b in (0, 3, 4, 7))
    assert pii.calibrated([(pii.tree_score(grown, b), p, n) for b, p, n in counts]) > max(score[b] for b in (0, 3, 4, 7))


def events(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, msg string, seq bigint, kind string, role string, text string")


def test_chat_folds_the_log(spark):
    log = [
        (1, 0, "a", 0, "open", "user", "Hi "), (1, 0, "a", 1, "delta", None, "there"), (1, 1, "b", 2, "open", "assistant", "Wrong"),
        (1, 2, "c", 3, "open", "user", "old follow-up"), (1, 1, "b", 4, "regenerate", None, None), (1, 1, "b", 5, "delta", None, "Right"),
        (1, 2, "c", 6, "open", "user", "new"), (1, 2, "c", 7, "edit", None, "newer [INST]"), (None, None, "z", None, "open", None, None),
    ]
    frame = events(spark, log[::-1])
    rows = sorted((r["conv_id"] or 0, r["position"], r["role"], r["text"]) for r in chat.format_chats(frame).collect())
    assert rows == [(0, 0, "", ""), (1, 0, "user", "Hi there"), (1, 1, "assistant", "Right"), (1, 2, "user", "newer [INST]")]
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_chat_messages(spark):
    long = "\\n[INST]" * 5000
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", long), (2, None, None, None), (None, 3, "assistant", "")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, kind string")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_chats(chat.events_of(frame))).collect()}
    assert got[1]["turns_sha256"] == brute.sha("".join(f"user\n{t}\n" for t in sorted("aab", key=brute.sha)) + f"assistant\n{long}\n")
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[2]["n_turns"], got[None]["loss_chars"]) == (4, len(long), 1, 0)


def test_chat_of_a_very_long_text(spark):
    """Five million code points, none of them ASCII, in one message: linear, so seconds."""
    long = "é\U0001f600\n[ü" * 1_000_000
    frame = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", long)], "conv_id bigint, turn bigint, role string, text string")
    start = time.monotonic()
    row = chat.digests(chat.format_chats(chat.events_of(frame))).first()
    assert time.monotonic() - start < 60
    assert (row["n_turns"], row["loss_chars"], row["loss_sha256"]) == (2, len(long), brute.sha(long))


@given(st.text(alphabet="\\n<>|[]/INSTsSYim_startendof \n", max_size=80), st.text(alphabet="\\n<|im_start|>\n[INST]s", max_size=20))
@settings(max_examples=300, deadline=None)
def test_chat_round_trip(text, role):
    piece, start, end = chat.render(role, text)
    assert chat.read_back(piece) == (role, text)
    assert not any(c in chat.escape(text) for c in chat.CONTROL)
    assert chat.unescape(piece[start:end]) == (text if role == chat.TRAINED else "")


def test_mixing(spark, docs, nobody):
    rows = [(r["doc_id"], r["size"], r["taken"]) for r in mixing.mixture(docs).collect()]
    assert sorted((i, n) for i, n, _ in rows) == sorted((i, len(brute.words(t))) for i, t in TEXTS)
    assert mixing.mixture(nobody).count() == 0 and mixing.mixed(nobody).count() == 0
    out = mixing.mixed(docs)
    assert out.columns == [*docs.columns, "copies"]
    taken = {i: t for i, _, t in rows}
    assert all(r["copies"] * len(brute.words(r["text"])) == taken[r["doc_id"]] for r in out.collect())


def test_cube_balances_words_and_documents(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "w " * int(n), s) for i, (n, s) in enumerate(zip(rng.integers(1, 300, 3000), rng.choice(["a", "b", "c", None], 3000, p=[0.6, 0.2, 0.1, 0.1]), strict=True))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    frame = frame.union(frame.where("doc_id = 5"))
    units = [r.asDict() for r in mixing.mix(frame, cell_rows=64).collect()]
    sizes = {}
    for r in units:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"] * r["rows"]
    want = brute.targets(sizes)
    for s in sizes:
        own = [r for r in units if r["source"] == s]
        assert own[0]["target"] == pytest.approx(want[s])
        assert sum(r["copies"] * r["size"] * r["rows"] for r in own) == pytest.approx(want[s], abs=20)
        assert sum(r["copies"] for r in own) == pytest.approx(len(own) * want[s] / sizes[s], rel=0.03)


def test_vectors(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(150):
        v = rng.normal(size=16)
        rows += [(3 * i, v.tolist(), i % 3), (3 * i + 1, (v + rng.normal(size=16) * 0.12).tolist(), i % 3), (3 * i + 2, rng.normal(size=16).tolist(), 0)]
    odd = [None, [], [0.0] * 16, [1.0, None], [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0], [2.0], [1e-30] * 16, [3e30] * 16]
    rows += [(1000 + i, v, 1) for i, v in enumerate(odd)] + [(2000, rows[0][1], 0), (2001, rows[0][1], None), (2002, rows[0][1], 0)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, label int, node string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in sphere.near_vectors(frame, cap=0.6, codes=16, turns=20).collect()}
    want = brute.near_vectors(rows, 0.93)
    links = sum(n for n, _ in want.values())
    assert all(got[i][0] <= n for i, (n, _) in want.items()) and sum(n for n, _ in got.values()) >= 0.99 * links > 100
    assert {i: got[i] for i, _, _ in rows if i >= 1000} == {i: want[i] for i, _, _ in rows if i >= 1000}
    assert sphere.near_vectors(frame.limit(0)).count() == 0


def test_pairs_at_the_limit_through_the_shapes_of_the_query(spark):
    """Thousands of vectors of a label, a pair in two of them at a cosine of 0.93 to 0.95."""
    rng = np.random.default_rng(12)
    rows, pairs = [], 0
    for label, count in ((0, 1500), (1, 600)):
        for i in range(count):
            v, w = rng.normal(size=(2, 64))
            v /= np.linalg.norm(v)
            w -= v * (v @ w)
            cosine = rng.uniform(0.9301, 0.95)
            near = cosine * v + np.sqrt(1 - cosine**2) * w / np.linalg.norm(w)
            rows += [(len(rows), v.tolist(), label), (len(rows) + 1, near.tolist(), label)]
            pairs += 1
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in sphere.near_vectors(frame).collect()}
    want = brute.near_vectors(rows, 0.93)
    assert sum(n for n, _ in want.values()) == 2 * pairs
    assert all(got[i][0] <= n for i, (n, _) in want.items())
    assert sum(n for n, _ in got.values()) >= 0.99 * 2 * pairs


def test_vectors_of_a_split_filter(spark, monkeypatch):
    monkeypatch.setattr(sphere, "BLOCK", 5)
    rng = np.random.default_rng(4)
    v = rng.normal(size=32)
    rows = [(i, (v + rng.normal(size=32) * 0.1).tolist(), 4) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in sphere.near_vectors(frame).collect()} == brute.near_vectors(rows, 0.93)


def test_language_gradients():
    net = language.Network(["a", "b", "c"], 4)
    for p in (net.ahead, net.back):
        p.X, p.U, p.C = p.X.astype(float), p.U.astype(float), p.C.astype(float)
    net.W, net.b = net.W.astype(float), net.b.astype(float)
    rng = np.random.default_rng(0)
    text, labels = rng.integers(97, 101, (6, 5)), np.array([0, 1, 2, 0, 1])
    for p, g in zip(net.parameters(), net.gradients(text, labels)[1], strict=True):
        at = tuple(rng.integers(0, s) for s in p.shape) if p.shape[-1] != 256 else (1, 98)
        old, losses = p[at], []
        for d in (1e-3, -1e-3):
            p[at] = old + d
            losses.append(net.gradients(text, labels)[0])
        p[at] = old
        assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(g[at], rel=2e-2, abs=1e-5)


def test_language(spark, docs, nobody):
    text = {"xx": "abc abd acd bcd ", "yy": "mno mnp nop pon "}
    rows = [(i, text[k] * (1 + i % 5), k) for i in range(40) for k in text]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    net = language.learn(frame)
    got = {r["doc_id"]: r for r in language.identify(spark.createDataFrame([(1, text["xx"] * 900), (2, "mno"), (3, None), (4, ""), (5, "12 !"), (6, "é")], "doc_id bigint, text string"), net).collect()}
    assert [got[i]["lang_pred"] for i in range(1, 6)] == ["xx", "yy", "und", "und", "und"] and got[6]["lang_pred"] in text
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language.learn(nobody) is None
    assert {r["lang_pred"] for r in language.identify(docs, None).collect()} == {"und"}
    kept = language.of_known_language(docs, net, 0.0)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, t in TEXTS if t and any(c.isalpha() for c in t)}
    assert language.identify(nobody, net).count() == 0


def test_texts_for_training_are_not_shuffled(spark, tmp_path):
    rows = [(i, f"text {i} of some length " * 9, "ab"[i % 2]) for i in range(3000)] + [(9000 + i, "one text that comes over and over again", "a") for i in range(1500)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "docs"))
    picked = language.training_windows(spark.read.parquet(str(tmp_path / "docs")), 100)
    got = picked.collect()
    assert {k: sum(r["lang"] == k for r in got) for k in "ab"} == {"a": 100, "b": 100}
    plan = picked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    below = [plan.splitlines()[i + 1 :] for i, line in enumerate(plan.splitlines()) if "Exchange" in line]
    assert below and all("text#" not in rest[0] for rest in below)
    assert len({r["h"] for r in got}) == 200  # copies count once


def test_toxicity(spark, docs, nobody):
    rng = np.random.default_rng(6)
    plain = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        words = list(rng.choice(plain, rng.integers(20, 60)))
        if i % 4 == 0:
            words[3:3] = list(rng.choice(["badword", "worseword"], 2))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (3, None), (9999, 1)], "doc_id bigint, toxic int")
    models, share = toxicity.learn(frame, marks)
    got = {r["doc_id"]: r for r in toxicity.score(frame, models, share).collect()}
    held = [i for i, r in got.items() if r["held_out"]]
    assert len(held) > 60 and sum(got[i]["predicted"] == labels[i][1] for i in held) >= 0.97 * len(held)
    odd = {r["doc_id"]: r["score"] for r in toxicity.score(docs, models, share).collect()}
    assert odd[3] == odd[4] == odd[5] == pytest.approx(share)
    assert toxicity.score(nobody, models, share).count() == 0
    assert toxicity.learn(frame, marks.limit(0)) == (None, 0.0)
    assert {r["score"] for r in toxicity.score(docs, None, 0.25).collect()} == {0.25}


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    n = 32_000
    frame = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("word"), F.col("id") % 40, F.when(F.col("id") % 2 == 0, " bad").otherwise("")).alias("text"))
    marks = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 2 == 0).cast("int").alias("toxic"))
    seen = {}
    trusted, fit = toxicity.trusted, toxicity.fit_logistic

    def see_trusted(counts, *sizes):
        seen["models"] = (counts.agg(F.max(F.col("toxic")), F.sum("plain")).first(), sizes)
        return trusted(counts, *sizes)

    def see_fit(rows, *rest):
        seen["fit"] = rows.count()
        return fit(rows, *rest)

    monkeypatch.setattr(toxicity, "trusted", see_trusted)
    monkeypatch.setattr(toxicity, "fit_logistic", see_fit)
    models, share = toxicity.learn(frame, marks)
    learned = marks.where(common.fold_of("doc_id", toxicity.FOLDS) != toxicity.HELD_OUT).withColumn("later", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0)
    rows = {(r["later"], r["toxic"]): r["count"] for r in learned.groupBy("later", "toxic").count().collect()}
    assert seen["models"][1] == (rows[False, 1], rows[False, 0]) and seen["models"][0][0] == rows[False, 1]
    assert seen["fit"] == rows[True, 0] + rows[True, 1]
    got = toxicity.score(frame, models, share).where("predicted != if(doc_id % 2 = 0, 1, 0)")
    assert got.count() == 0
