"""Text helpers for tasks: words, shingles and hashes of whole Arrow batches at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, as bytes. [fixed values]
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Texts are worked on in pieces of about this many bytes; a longer one comes in several.
PIECE_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Cache(dict):
    """Is empty again wherever it is sent."""

    def __reduce__(self):
        return dict, ()


_POWERS: dict[str, np.ndarray] = _Cache()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2**64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 2 * PIECE_BYTES)
        for name, base in (("up", int(_ODD)), ("down", pow(int(_ODD), -1, 1 << 64))):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            _POWERS[name] = np.multiply.accumulate(run)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an Arrow string column and their bounds; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, where, data = column.buffers()
    bounds = np.frombuffer(where, kind, len(column) + 1, column.offset * kind().itemsize).astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(bounds: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes each; every row is in exactly one."""
    first, n, most = 0, len(bounds) - 1, most or PIECE_BYTES
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = last


def chunks(data: np.ndarray, bounds: np.ndarray, between: np.ndarray = _IS_SPACE, size: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bool]]:
    """Rows [first, last), some of their bytes, the rows' bounds in these, and whether a row goes on from the chunk before.

    A text longer than ``size`` comes alone and in several chunks, cut between words; one longer word is one chunk.
    """
    size = size or PIECE_BYTES
    for first, last in pieces(bounds, size):
        if last - first > 1 or bounds[last] - bounds[first] <= size:
            yield first, last, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first], False
            continue
        start, end = int(bounds[first]), int(bounds[last])
        at = start
        while at < end:
            to = min(at + size, end)
            while to < end and not between[data[to]]:
                gap = np.flatnonzero(between[data[to : min(to + size, end)]])
                to = to + int(gap[0]) if len(gap) else min(to + size, end)
            yield first, last, data[at:to], np.array([0, to - at]), at > start
            at = to


def word_bounds(data: np.ndarray, bounds: np.ndarray, between: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; ``between`` tells of every byte whether it separates words."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gap = between[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    solid = ~gap
    starts = np.flatnonzero(solid & (np.concatenate(([True], gap[:-1])) | edge[:-1]))
    return starts, np.flatnonzero(solid & (np.concatenate((gap[1:], [True])) | edge[1:])) + 1


class Hashes:
    """Hashes of any runs of some bytes, A-Z lowered."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LOWER[data] * up[: len(data)], out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * self.down[starts] ^ (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, bounds: np.ndarray, between: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, A-Z lowered, and each row's bounds in the list of words."""
    starts, ends = word_bounds(data, bounds, between)
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    return Hashes(data).of(starts, ends), np.searchsorted(starts, bounds)


def words_of_rows(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows [first, last), the hashes of their words and the rows' bounds among these.

    A long text is read in chunks, so that besides its words only one chunk is in work at a time.
    """
    parts: list[np.ndarray] = []
    open_row = None
    for first, last, part, within, goes_on in chunks(data, bounds):
        if open_row is not None and not goes_on:
            words = np.concatenate(parts)
            yield open_row, open_row + 1, words, np.array([0, len(words)])
            open_row, parts = None, []
        words, at = word_hashes(part, within)
        if goes_on or (last - first == 1 and bounds[last] - bounds[first] > len(part)):
            open_row = first
            parts.append(words)
        else:
            yield first, last, words, at
    if open_row is not None:
        words = np.concatenate(parts)
        yield open_row, open_row + 1, words, np.array([0, len(words)])


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every run of k words of a row; the whole row as one run where it has fewer.

    Returns the hashes and each row's bounds among them. Rows without words have none.
    """
    counts = np.diff(bounds)
    sizes = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(out_bounds[-1], np.uint64)
    if len(words) >= k:
        runs = np.zeros(len(words) - k + 1, np.uint64)
        for j in range(k):
            runs += words[j : len(words) - k + 1 + j] ^ np.uint64(j + 1)
            runs = mix(runs)
    for row in np.flatnonzero(counts > 0):
        if counts[row] >= k:
            out[out_bounds[row] : out_bounds[row + 1]] = runs[bounds[row] : bounds[row] + sizes[row]]
        else:
            value = np.array([counts[row]], np.uint64) * _ODD
            for j in range(counts[row]):
                value = mix(value * np.uint64(3) + words[bounds[row] + j])
            out[out_bounds[row]] = value[0]
    return out, out_bounds


def batch_of(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [v if isinstance(v, pa.Array) else pa.array(v, schema.field(n).type) for n, v in columns.items()]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def fold_of(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo the number of parts; rows without an id are in no part."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(parts)


def map_rows(docs: DataFrame, run, **more: Column) -> DataFrame:
    """``docs.mapInArrow`` with the same columns out as in, whatever their names.

    ``run`` finds doc_id and text under these names, the columns of ``more`` under theirs; it gives all but the latter back.
    """
    names = [c.lower() if c.lower() in ("doc_id", "text") else f"column {i}" for i, c in enumerate(docs.columns)]
    plain = docs.select(*[F.col(f"`{c}`").alias(name) for c, name in zip(docs.columns, names, strict=True)])
    extended = plain.select("*", *[value.alias(name) for name, value in more.items()])
    return extended.mapInArrow(run, plain.schema).toDF(*docs.columns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code_points(text: Column) -> Column:
    return F.coalesce(F.length(text), F.lit(0))
