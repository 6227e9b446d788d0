"""Benchmark decontamination by size-partitioned MinHash containment search.

An item of m shingles inside a long document has a tiny Jaccard similarity with the whole
document, so items are partitioned by size: class c holds items of 2**c .. 2**(c+1) - 1
shingles. For each class a document is cut into blocks of 2**(c+1) shingles and every two
neighbouring blocks form a window, so that each passage as long as an item of the class lies
inside one window, of which it is at least a fifth. ``HASHES`` universal hash functions with one row per
band then propose an item unless all of them miss: below 0.81 ** 48 = 4e-5 for a passage at the
containment limit. Every proposal is verified by exact containment of the item's shingles in
the whole document.

Items travel to the tasks in blocks of at most about ``BLOCK_WORDS`` words, one pass over the documents for
each block, so that what is broadcast stays bounded however many items there are.
Documents are never shuffled.

Items with fewer than ``k`` words (null and empty ones too) have no shingle and match nothing. Documents
without words match nothing. Repeated document rows give repeated pairs. A row per
(document row, item id): of several items with one id the best containment counts. Other
columns are ignored by ``leaked_items`` and passed through by ``without_leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import common

K = 5
CONTAINMENT = 0.8
HASHES = 48
BLOCK_WORDS = 2_000_000
PAIRS = "doc_id bigint, item_id bigint, n_shared bigint, n_item bigint, containment double"
_PAIRS = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_shared", pa.int64()), ("n_item", pa.int64()), ("containment", pa.float64())]
)
_TABLE_BITS = 20
_MOST = np.uint32(0xFFFFFFFF)


def hash_family(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-shift hash functions: the high half of a * x + b for 32-bit x."""
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(0, 1 << 64, (count, 1), np.uint64) | np.uint64(1), rng.integers(0, 1 << 64, (count, 1), np.uint64)


def hashed(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One row per hash function."""
    return ((family[0] * (shingles >> np.uint64(32)) + family[1]) >> np.uint64(32)).astype(np.uint32)


class ItemIndex:
    """Minima of the items of one block, by size class and hash function."""

    def __init__(self, ids: list, texts: list, k: int, hashes: int):
        self.k, self.family = k, hash_family(hashes, 7)
        self.ids, self.sets = [], []
        keys, owners, classes = [], [], set()
        data, bounds = common.buffers(pa.array(texts, pa.string()))
        words, word_bounds = common.word_hashes(data, bounds)
        counts = np.diff(word_bounds)
        shingles, where = common.shingle_hashes(words, word_bounds, k)
        for row in np.flatnonzero(counts >= k):
            grams = np.unique(shingles[where[row] : where[row + 1]])
            level = len(grams).bit_length() - 1
            classes.add(level)
            for j, low in enumerate(hashed(grams, self.family).min(axis=1)):
                keys.append(self.key(level, j, int(low)))
                owners.append(len(self.ids))
            self.ids.append(ids[row])
            self.sets.append(grams)
        order = np.argsort(np.array(keys, np.uint64), kind="stable")
        self.keys, self.owners = np.array(keys, np.uint64)[order], np.array(owners, np.int64)[order]
        self.classes = sorted(classes)
        self.seen = np.zeros(1 << _TABLE_BITS, bool)
        self.seen[self.keys & np.uint64((1 << _TABLE_BITS) - 1)] = True

    @classmethod
    def received(cls, state: dict) -> ItemIndex:
        """The index from what was broadcast of it."""
        index = cls.__new__(cls)
        index.__dict__.update(state)
        return index

    @staticmethod
    def key(level: int, function: int, low: int) -> int:
        return level << 48 | function << 32 | low

    def proposals(self, shingles: np.ndarray) -> np.ndarray:
        """Items that share a minimum with some window of the document."""
        found = []
        step = 1 << (self.classes[-1] + 1)
        part = max(step, 4096 // step * step)
        columns: dict[int, list[np.ndarray]] = {level: [] for level in self.classes}
        for first in range(0, len(shingles), part):  # bounded memory for long documents
            values = hashed(shingles[first : first + part], self.family)
            for level in self.classes:
                size = 1 << (level + 1)
                columns[level].append(np.minimum.reduceat(values, np.arange(0, values.shape[1], size), axis=1))
        functions = np.arange(len(self.family[0]), dtype=np.uint64)[:, None] << np.uint64(32)
        for level in self.classes:
            blocks = np.concatenate(columns[level], axis=1)
            lows = blocks if blocks.shape[1] == 1 else np.minimum(blocks[:, :-1], blocks[:, 1:])
            hits = self.seen[lows & np.uint32((1 << _TABLE_BITS) - 1)]
            if hits.any():
                keys = (lows.astype(np.uint64) | functions | np.uint64(level << 48))[hits]
                left, right = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, "right")
                for a, b in {(a, b) for a, b in zip(left.tolist(), right.tolist(), strict=True) if a < b}:
                    found.append(self.owners[a:b])
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)

    def matches(self, shingles: np.ndarray, least: float) -> dict[int, tuple[int, int]]:
        """Item id -> shared and own shingles, for items contained to at least ``least``."""
        out: dict = {}
        proposed = self.proposals(shingles) if len(shingles) and self.ids else ()
        if len(proposed):
            have = np.unique(shingles)
            for item in proposed:
                grams = self.sets[item]
                at = np.minimum(np.searchsorted(have, grams), len(have) - 1)
                shared = int((have[at] == grams).sum())
                if shared >= least * len(grams) - 1e-9:
                    one = (shared, len(grams))
                    best = out.get(self.ids[item])
                    if best is None or shared * best[1] > best[0] * len(grams):
                        out[self.ids[item]] = one
        return out


def _scan(batch: pa.RecordBatch, index: ItemIndex, least: float) -> Iterator[tuple[int, dict]]:
    data, bounds = common.buffers(batch.column("text"))
    for first, _, words, word_bounds in common.words_of_rows(data, bounds):
        shingles, where = common.shingle_hashes(words, word_bounds, index.k)
        counts = np.diff(word_bounds)
        for row in np.flatnonzero(counts >= index.k):
            yield first + int(row), index.matches(shingles[where[row] : where[row + 1]], least)


def _indexes(docs: DataFrame, items: DataFrame, k: int, hashes: int) -> Iterator[object]:
    """One broadcast index per block of items."""
    spark = docs.sparkSession
    items = items.select("item_id", "text").where("isnotnull(text)").distinct()
    total = items.agg(F.sum(F.length("text") / 5 + 1)).first()[0] or 0
    blocks = max(1, ceil(total / BLOCK_WORDS))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        index = ItemIndex([r["item_id"] for r in rows], [r["text"] for r in rows], k, hashes)
        if index.ids:
            yield spark.sparkContext.broadcast(vars(index))


def leaked_items(docs: DataFrame, items: DataFrame, k: int = K, least: float = CONTAINMENT, hashes: int = HASHES) -> DataFrame:
    """Pairs (doc_id, item_id) whose item is contained in the document to at least ``least``."""

    def search(index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = ItemIndex.received(index.value)
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                out = [(ids[row], i, s, n, s / n) for row, hit in _scan(batch, own, least) for i, (s, n) in hit.items()]
                if out:
                    yield common.batch_of(dict(zip(_PAIRS.names, zip(*out, strict=True), strict=True)), _PAIRS)

        return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, PAIRS)

    found = [search(index) for index in _indexes(docs, items, k, hashes)]
    if not found:
        return docs.sparkSession.createDataFrame([], PAIRS)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def without_leaks(docs: DataFrame, items: DataFrame, k: int = K, least: float = CONTAINMENT, hashes: int = HASHES) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    for index in _indexes(docs, items, k, hashes):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            own = ItemIndex.received(index.value)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for row, hit in _scan(batch, own, least):
                    keep[row] = not hit
                yield batch.filter(pa.array(keep))

        docs = common.map_rows(docs, run)
    return docs
