"""Importance resampling to a target distribution: array-scored weights, then distributed quickselect.

Words are runs of digits, a-z (A-Z lowered) and bytes above 127. A feature is a word; its bucket is the crc32 of its bytes modulo
``BUCKETS``. The counts of all buckets over the source and over the target documents give each bucket
a gain, floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))); a document's weight is the sum over its features, looked up in
one array of gains. With Gumbel noise from a hash of the document's id added, the highest scores are a draw
without replacement in proportion to exp(weight / 1000).

The k-th highest composite key (score falling, doc_id, row) is found without a sort: a few random rows of the open
range are pivots, one pass counts exactly how many keys come before each and how many equal it, and the range narrows
to the gap that holds the k-th; the open range shrinks by about ``PIVOTS`` a pass. Only the winners are sorted, by range
partitions, and ranked: each partition's rows are numbered from the number of winners before it.

Rows of one doc_id share their noise and are ordered by their place in the written table of scores. A row without
a doc_id has no noise: its score is null, it does not count for N and is not drawn. Null and empty texts have no
features and weight 0. Documents with fewer words than ``LEAST_WORDS`` are scored, not drawn. Empty tables: no target leaves
gains that only shrink frequent buckets; no documents give an empty result. Other columns are ignored. The
driver holds ``BUCKETS`` counts and ``PIVOTS`` keys. Texts are read in chunks cut between words, one longer word is one chunk.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm import common
from forecourt.session import materialise

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
PIVOTS = 24
CHUNK = 1 << 19
#: Longer words are hashed one by one.
SHORT = 48

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_IN_WORD[128:] = True
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> np.uint32(1)) ^ np.uint32(0xEDB88320), _CRC >> np.uint32(1))


def word_buckets(data: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Start and bucket of every word of some bytes, which begin and end between words."""
    solid = _IN_WORD[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], solid, [False])).view(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    low = _LOWER[data]
    sizes = ends - starts
    order = np.argsort(-np.minimum(sizes, SHORT + 1), kind="stable")
    sizes, first = sizes[order], starts[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    long = int(np.searchsorted(-sizes, -SHORT, "left"))  # the words of more bytes come first
    for i in range(long):
        crc[i] = zlib.crc32(low[first[i] : first[i] + sizes[i]]) ^ 0xFFFFFFFF
    for at in range(int(sizes[long]) if long < len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -at, "left"))  # words with more than ``at`` bytes
        now = crc[long:n]
        crc[long:n] = _CRC[(now ^ low[first[long:n] + at]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out = np.empty(len(order), np.int64)
    out[order] = (crc ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)
    return starts, out


def _features(column: pa.Array, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows [first, last), the row of each word counted from first, and its bucket."""
    data, bounds = common.buffers(column)
    for first, last, part, within, _ in common.chunks(data, bounds, ~_IN_WORD, CHUNK):
        # words do not run from one text into the next
        apart = np.full(len(part) + last - first, 32, np.uint8)
        shift = np.repeat(np.arange(last - first), np.diff(within))
        apart[np.arange(len(part)) + shift] = part
        starts, found = word_buckets(apart, buckets)
        yield first, last, np.searchsorted(within[1:] + np.arange(1, last - first + 1), starts, "right"), found


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: features of all texts (column text) per bucket that has any."""
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, found in _features(batch.column("text"), buckets):
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], schema=schema)

    return texts.select(F.col("text").cast("string")).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, as integers; at most ``buckets`` rows come to the driver."""
    both = bucket_counts(docs, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("bigint").alias("t"))
    both = both.union(bucket_counts(target, buckets).select("bucket", F.lit(0).cast("bigint"), "n"))
    each = docs.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("bigint").alias("s"), F.lit(0).cast("bigint").alias("t"))
    each = each.union(both).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    rows = each.orderBy("bucket").collect()
    s, t = (np.array([r[c] for r in rows], np.float64) for c in "st")
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_features, weight of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)
    schema = pa.schema([("doc_id", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            n, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(2))
            for first, last, row, found in _features(batch.column("text"), len(own)):
                n[first:last] += np.bincount(row, minlength=last - first)
                # whole numbers far below 2**53 stay exact in doubles
                weight[first:last] += np.bincount(row, own[found], minlength=last - first).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(weight)], schema=schema)

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return texts.mapInArrow(run, "doc_id bigint, n_features bigint, weight bigint")


def noise(seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from doc_id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


Key = tuple[int, int, int]


def before(key: Key, or_equal: bool = False) -> Column:
    """Rows whose composite key comes before this one."""
    score, doc_id, row = (F.lit(v).cast("bigint") for v in key)
    last = F.col("row") <= row if or_equal else F.col("row") < row
    return (F.col("score") > score) | ((F.col("score") == score) & ((F.col("doc_id") < doc_id) | ((F.col("doc_id") == doc_id) & last)))


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS) -> Key:
    """The k-th key (from 1) of at least k rows (score, doc_id, row; no nulls, rows differ)."""
    low: Key | None = None  # the k-th comes after it
    high: Key | None = None  # and not after this one
    turn = 0
    while True:
        open_rows = rows
        if low:
            open_rows = open_rows.where(~before(low, or_equal=True) & (F.col("score") <= low[0]))
        if high:
            open_rows = open_rows.where(before(high, or_equal=True) & (F.col("score") >= high[0]))
        drawn = open_rows.orderBy(F.xxhash64("row", F.lit(turn)), "row").limit(pivots).collect()
        keys = sorted(((r["score"], r["doc_id"], r["row"]) for r in drawn), key=lambda x: (-x[0], x[1], x[2]))
        counts = rows.agg(*[F.count_if(before(p)).alias(f"n{i}") for i, p in enumerate(keys)]).first()
        for key, ahead in zip(keys, counts, strict=True):
            if ahead == k - 1:
                return key
            if ahead < k - 1:
                low = key
            else:
                high = key
                break
        turn += 1


def ranked(winners: DataFrame) -> DataFrame:
    """All rows with their rank by (score falling, doc_id, row) in a new column rank."""
    order = [F.col("score").desc(), F.col("doc_id"), F.col("row")]
    parts = materialise(winners.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "winners")
    sizes = sorted((r["part"], r["count"]) for r in parts.groupBy("part").count().collect())  # one row per partition
    starts, done = {}, 0
    for part, n in sizes:
        starts[part], done = done, done + n
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)).cast("bigint")
    if not starts:
        return winners.withColumn("rank", F.lit(None).cast("bigint"))
    first = F.element_at(F.create_map(*[F.lit(v).cast("bigint") for item in starts.items() for v in item]), F.col("part").cast("bigint"))
    return parts.withColumn("rank", place + first).drop("part")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_features, weight, score, rank (null: not drawn). target: text."""
    weighed = weigh(docs, gains(docs, target, buckets))
    scored = weighed.withColumn("score", F.col("weight") + noise(seed)).withColumn("row", F.monotonically_increasing_id())
    scored = materialise(scored, "scored")
    able = F.isnotnull("doc_id") & (F.col("n_features") >= least_words)
    pool = scored.where(able).select("score", "doc_id", "row")
    k = percent * pool.count() // 100
    if k:
        drawn = able & before(kth_key(pool, k), or_equal=True)
        rows = ranked(scored.where(drawn)).union(scored.where(~F.coalesce(drawn, F.lit(False))).withColumn("rank", F.lit(None).cast("bigint")))
    else:
        rows = scored.withColumn("rank", F.lit(None).cast("bigint"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")
