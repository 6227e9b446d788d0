"""Removal of repeated byte strings by bucket-pointer refinement of a sparse suffix array.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts earlier: in a document with a
smaller id, or earlier in the same one. Strings never cross documents and are judged on the input.

1. Every window of LENGTH bytes points at the smallest hash among its q-grams (q = LENGTH / 4, leftmost among
   equals). These anchors depend on the window's bytes only, so equal windows have equal anchors
   at equal places; about one suffix in 38 is an anchor, and the suffix array is kept for these only.
2. The anchors' q-grams are the initial buckets. Buckets of one anchor are done; they are told
   by counting, with partial counts before the shuffle.
3. The others bring the bytes of their windows. The windows of a bucket, told apart by their offset to the anchor,
   are refined by sorting on the bucket identifiers of later offsets: identifiers of q bytes split the
   buckets at offset 0, then at q, which gives those of 2q bytes, and these, reused at offset 2q, split to 4q = LENGTH.
   Buckets of one window leave at every step.
4. In a final bucket all windows but those at the first position are marked. A bucket of more than
   ``SPLIT`` anchors is dealt out to several tasks, each of which marks what it can and names the first of each distinct window;
   a shuffle by identifier finds the first of these.

Documents whose whole text is that of a smaller id are removed by digest in the same sense, without
refinement. The texts are shuffled once by id; both joins with them share that exchange.

Null texts are empty; texts under LENGTH bytes lose nothing. A null id counts as smaller than all others. Rows of one id
are one document in the order of positions: equal positions are not earlier than each other. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm import common
from forecourt.operators.skew import group_apart
from forecourt.session import materialise

LENGTH = 100
Q = LENGTH // 4
SPLIT = 2000
_NO_ID = -(1 << 63)
_SPAN = LENGTH - Q + 1  # q-grams of a window
_LOW = np.uint64(127)
_CHUNK = 8192

_ANCHORS = pa.schema([("id", pa.int64()), ("gram", pa.int64()), ("at", pa.int64())])
_CONTEXTS = pa.schema(
    [("gram", pa.int64()), ("n", pa.int64()), ("id", pa.int64()), ("start", pa.int64()), ("offset", pa.int32()), ("bytes", pa.binary())]
)
_RUNS = pa.schema(
    [("k1", pa.int64()), ("k2", pa.int64()), ("id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("sure", pa.bool_())]
)
_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
)
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def gram_hashes(data: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q bytes from each position on."""
    if len(data) < q:
        return np.empty(0, np.uint64)
    up, down = common.powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return common.mix((total[q:] - total[:-q]) * down[: len(data) - q + 1])


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each anchor: row, hash, offset in its text, and the distances to the first and last window it serves."""
    starts, ends = bounds[:-1], bounds[1:]
    long = ends - starts >= LENGTH
    if not long.any():
        return tuple(np.empty(0, np.int64) for _ in range(5))
    change = np.zeros(len(data) + 1, np.int32)
    np.add.at(change, starts[long], 1)
    np.add.at(change, ends[long] - LENGTH + 1, -1)
    p = np.flatnonzero(np.cumsum(change))
    hashes = gram_hashes(data, Q)
    blocks = -(-len(hashes) // _SPAN)
    packed = np.full(blocks * _SPAN, 0xFFFFFFFFFFFFFFFF, np.uint64)
    packed[: len(hashes)] = hashes & ~_LOW
    packed = packed.reshape(blocks, _SPAN)
    packed[:, :] = packed & ~_LOW | np.arange(_SPAN, dtype=np.uint64)
    after = np.minimum.accumulate(packed[:, ::-1], axis=1)[:, ::-1].reshape(-1)[p]
    until = np.minimum.accumulate(packed, axis=1).reshape(-1)[p + _SPAN - 1]
    left = after >> np.uint64(7) <= until >> np.uint64(7)
    best = np.where(left, after, until)
    at = np.where(left, p, p + _SPAN - 1) // _SPAN * _SPAN + (best & _LOW).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (p[1:] != p[:-1] + 1))))
    last = np.concatenate((new[1:], [len(p)])) - 1
    at = at[new]
    row = np.searchsorted(bounds, at, "right") - 1
    return row, (best[new] >> np.uint64(7)).astype(np.int64), at - bounds[row], at - p[new], at - p[last]


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = common.buffers(batch.column("text"))
        ids = batch.column("id").to_numpy()
        for first, last in common.pieces(bounds):
            for start, part, within in _overlapping(data, bounds, first, last):
                row, gram, offset, low, high = anchors(part, within)
                if len(row):
                    at = (start + offset) << 14 | low << 7 | high
                    yield pa.RecordBatch.from_arrays([pa.array(ids[first + row]), pa.array(gram), pa.array(at)], schema=_ANCHORS)


def _overlapping(data: np.ndarray, bounds: np.ndarray, first: int, last: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The bytes of rows, or chunks of one long row: every window lies in one of them. Start in the row, bytes, bounds."""
    at, end, size = int(bounds[first]), int(bounds[last]), common.PIECE_BYTES
    if last - first > 1 or end - at <= size:
        yield 0, data[at:end], bounds[first : last + 1] - at
        return
    for start in range(at, max(at + 1, end - LENGTH + 1), size):
        part = data[start : min(start + size + LENGTH - 1, end)]
        yield start - at, part, np.array([0, len(part)])


def grams_at(data: np.ndarray, offsets: np.ndarray, q: int) -> np.ndarray:
    """The hashes of the q bytes from some positions on."""
    up, _ = common.powers(q)
    out = np.empty(len(offsets), np.uint64)
    for i in range(0, len(offsets), _CHUNK):
        some = offsets[i : i + _CHUNK]
        out[i : i + _CHUNK] = ((data[some[:, None] + np.arange(q)].astype(np.uint64) + np.uint64(1)) * up).sum(axis=1)
    return common.mix(out)


def _bring_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of all windows of each anchor that has partners (id, text, whole, found)."""
    for whole in batches:
        for first in range(0, whole.num_rows, 256):
            batch = whole.slice(first, 256)
            out: list[list] = [[], [], [], [], [], []]
            texts, ids, copies = batch.column("text"), batch.column("id").to_pylist(), batch.column("whole").to_pylist()
            for k in range(batch.num_rows):
                found = batch.column("found")[k].values
                if copies[k] or found is None or not len(found):
                    continue
                text = (texts[k].as_py() or "").encode()
                gram, n, at = (found.field(i).to_numpy() for i in range(3))
                offset, low, high = at >> 14, at >> 7 & 127, at & 127
                # another row with this id may have brought anchors of another text
                good = (offset + Q <= len(text)) & (offset >= low) & (offset - high + LENGTH <= len(text))
                hashes = grams_at(np.frombuffer(text, np.uint8), offset[good], Q) >> np.uint64(7)
                good[good] = hashes.astype(np.int64) == gram[good]
                for g, m, o, a, b in zip(gram[good].tolist(), n[good].tolist(), offset[good].tolist(), low[good].tolist(), high[good].tolist(), strict=True):
                    for column, value in zip(out, (g, m, ids[k], o - a, a, text[o - a : o - b + LENGTH]), strict=True):
                        column.append(value)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _CONTEXTS, strict=True)], schema=_CONTEXTS)


def _drop_single(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries share their bucket, and the numbers of these buckets."""
    _, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
    stay = np.flatnonzero(counts[place] > 1)
    return stay, place[stay].astype(np.uint64)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return common.mix(common.mix(a) + b)


def refine(gram: np.ndarray, ids: np.ndarray, start: np.ndarray, offset: np.ndarray, data: np.ndarray, bounds: np.ndarray, split: np.ndarray):
    """Marked windows (id, position), and the first of each distinct window of split buckets (k1, k2, id, position)."""
    windows = np.diff(bounds) - LENGTH + 1
    of = np.repeat(np.arange(len(windows)), windows)
    step = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    s, position = bounds[:-1][of] + step, start[of] + step
    q1 = gram_hashes(data, Q)
    q2 = _join(q1[:-Q], q1[Q:])
    root = _join(gram[of].astype(np.uint64), (offset[of] - step).astype(np.uint64))
    # windows of split buckets keep their full identifiers, to be compared elsewhere
    held = np.flatnonzero(split[of])
    k2 = _join(q2[s[held]], q2[s[held] + 2 * Q])
    live, bucket = _drop_single(_join(root, q1[s]))
    for later in (q1, q2):
        shift = Q if later is q1 else 2 * Q
        stay, bucket = _drop_single(_join(bucket, later[s[live] + shift]))
        live = live[stay]
    order = np.lexsort((position[live], ids[of[live]], bucket))
    live, bucket = live[order], bucket[order]
    new = np.concatenate(([True], bucket[1:] != bucket[:-1])) if len(live) else np.empty(0, bool)
    head = live[np.maximum.accumulate(np.where(new, np.arange(len(live)), 0))] if len(live) else live
    late = (ids[of[live]] != ids[of[head]]) | (position[live] != position[head])
    marked = live[late]
    first = held[~np.isin(held, marked)] if len(held) else held
    k2 = k2[~np.isin(held, marked)] if len(held) else k2
    return (ids[of[marked]], position[marked]), (root[first].view(np.int64), k2.view(np.int64), ids[of[first]], position[first])


def _runs(ids: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of bytes covered by windows at these positions, one per run of neighbours."""
    order = np.lexsort((position, ids))
    ids, position = ids[order], position[order]
    new = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (position[1:] > position[:-1] + 1))))
    last = np.concatenate((new[1:], [len(ids)])) - 1
    return ids[new], position[new], position[last] + LENGTH


def _refine_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    rows = 0

    def work(table: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        gram, n, ids, start = (table.column(c).to_numpy() for c in ("gram", "n", "id", "start"))
        data, bounds = common.buffers(table.column("bytes"))
        marked, first = refine(gram, ids, start, table.column("offset").to_numpy().astype(np.int64), data, bounds, n > SPLIT)
        if len(marked[0]):
            who, begin, end = _runs(*marked)
            yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(begin), pa.array(who), pa.array(begin), pa.array(end), pa.array(np.ones(len(who), bool))], schema=_RUNS)
        if len(first[0]):
            k1, k2, who, begin = first
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1), pa.array(k2), pa.array(who), pa.array(begin), pa.array(begin + LENGTH), pa.array(np.zeros(len(who), bool))], schema=_RUNS
            )

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= _CHUNK:
            joined = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            keys = list(zip(joined.column("gram").to_pylist(), joined.column("salt").to_pylist(), strict=True))
            cut = len(keys)
            while cut and keys[cut - 1] == keys[-1]:  # the last bucket may go on
                cut -= 1
            if cut:
                yield from work(joined.slice(0, cut))
            held, rows = [joined.slice(cut)], joined.num_rows - cut
    if rows:
        yield from work(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def merged(runs: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def kept_bytes(text: bytes, runs: list[list[int]]) -> bytes:
    at, parts = 0, []
    for start, end in runs:
        parts.append(text[at:start])
        at = end
    return b"".join([*parts, text[at:]])


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("id", "whole", "runs"))
        for doc_id, whole, runs, text in zip(*columns, batch.column("text"), strict=True):
            data = (text.as_py() or "").encode()
            cut = [[0, len(data)]] if whole else merged([(r["start"], min(r["end"], len(data))) for r in runs or () if r["start"] < len(data)])
            kept = kept_bytes(data, cut)
            out.append((None if doc_id == _NO_ID else doc_id, len(data), len(data) - len(kept), len(cut), hashlib.sha256(kept).hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _RESULT, strict=True)], schema=_RESULT)


def _whole_copy(text: DataFrame):
    return F.coalesce(F.array_contains("copies", F.md5("text")), F.lit(False)).alias("whole")


def removed_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts by id (id, text), and per id what to remove (id, runs, copies: digests of texts that go whole)."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("id"), "text")
    found = texts.mapInArrow(_find_anchors, "id bigint, gram bigint, at bigint")
    repeated = group_apart(found, ["gram"], F.count(F.lit(1)).alias("n")).where("n > 1")
    found = materialise(found.join(repeated, "gram").select("id", "gram", "n", "at"), "anchors")
    digests = texts.where(F.octet_length("text") >= LENGTH).select("id", F.md5("text").alias("digest"))
    firsts = group_apart(digests, ["digest"], F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    copies = materialise(digests.join(firsts, "digest").where("id > first").select("id", "digest").distinct(), "copies")
    by_id = copies.groupBy("id").agg(F.collect_set("digest").alias("copies"))
    parted = texts.repartition("id")
    lists = found.groupBy("id").agg(F.collect_list(F.struct("gram", "n", "at")).alias("found"))
    about = lists.join(by_id, "id", "left").hint("shuffle_hash")
    contexts = parted.join(about, "id").select("id", "text", _whole_copy(parted), "found").mapInArrow(
        _bring_contexts, "gram bigint, n bigint, id bigint, start bigint, offset int, bytes binary"
    )
    salt = F.pmod(F.xxhash64("id", "start"), F.ceil(F.col("n") / SPLIT)).alias("salt")
    runs = contexts.select("*", salt).repartition("gram", "salt").sortWithinPartitions("gram", "salt").mapInArrow(
        _refine_buckets, "k1 bigint, k2 bigint, id bigint, start bigint, end bigint, sure boolean"
    )
    head = F.min(F.struct("id", "start")).over(Window.partitionBy("k1", "k2"))
    runs = runs.withColumn("head", head).where("sure or id <> head.id or start <> head.start")
    runs = runs.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    return parted, runs.join(by_id, "id", "full")


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    texts, cuts = removed_spans(docs)
    joined = texts.join(cuts.hint("shuffle_hash"), "id", "left").select("id", "text", _whole_copy(texts), "runs")
    return joined.mapInArrow(_report, RESULT)
