"""Embedding near-dedup with spherical-cap filters.

A filter is a direction; a vector belongs to all filters whose direction it meets at a cosine of ``cap``
or more. The directions are structured: in each of ``turns`` random rotations of the space, a random product code
joins one of ``codes`` unit vectors of the first half of the coordinates with one of ``codes`` of the second, which
makes codes ** 2 directions. A vector's exceeding directions are list-decoded from its 2 * codes
inner products. Vectors are joined on (label, filter) and each pair that meets is verified by its cosine in
double precision.

* ``shape_of`` sets cap and codes from the length of the vectors and the number of different ones in the largest label:
  the cap at which decoding, belonging to filters and meeting unrelated vectors in them cost least together, and so many codes that
  a pair at the wanted cosine shares ``SHARED`` filters on average. So a larger table gets narrower and more filters, with the same
  chance to meet; the number of filters a vector belongs to grows slowly.
* Equal vectors of a label are one node with a number of copies, folded before any shuffle of filters.
* Every node has a sketch, the signs of ``SIGNS`` random projections. A member of a small filter goes on only if its sketch differs from
  that of another member in at most ``FAR`` signs, so unrelated vectors that share a filter cost a few bytes and not their
  coordinates. A pair at the wanted cosine is farther apart than that less than once in 100,000 times.
* A filter with many members is split into blocks of about ``BLOCK``, and every two blocks meet in a
  task of their own as one matrix product, so no task holds a whole filter.
* A linked pair counts in the smallest filter that both have; so n_links is exact for what was found, without
  a list of all pairs. For components each block gives one edge per linked node.

Vectors that are null, empty, zero, or hold nulls or non-finite numbers, and vectors without a label or id,
link with nothing. Vectors of different lengths never link. Rows of one vec_id count as separate vectors but share their component.
Other columns are ignored; the empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import common
from forecourt.llm.components import components
from forecourt.session import materialise

COSINE = 0.93
#: Filters that a pair at the wanted cosine shares on average.
SHARED = 20
TURNS = 20
#: Shapes are worked out from this length on; shorter vectors need few directions, whatever their number.
LEAST_LENGTH = 8
FEW_CAP, FEW_CODES = 0.42, 8
#: Cost of a member met in a filter, and of a code word of a rotation, against that of belonging to a filter.
MEET_COST, CODE_COST = 4, 0.007
BLOCK = 256
SIGNS, FAR = 128, 34
_CACHE: dict = common._Cache()


def shape_of(length: int, vectors: int, cosine: float, turns: int) -> tuple[float, int]:
    """Cap and codes for ``vectors`` of one label, by the areas of spherical caps and of their overlaps."""
    key = ("shape", length, vectors, cosine, turns)
    if key in _CACHE:
        return _CACHE[key]
    if length < LEAST_LENGTH:
        return FEW_CAP, FEW_CODES
    at = np.linspace(-1, 1, 20001)
    # first coordinate of a random direction, and of its part square to the first coordinate
    first, second = (np.maximum(1 - at**2, 0) ** ((length - k) / 2) for k in (3, 4))
    first, beyond = first / first.sum(), np.cumsum(second[::-1])[::-1] / second.sum()
    best = None
    for cap in np.arange(0.02, np.sqrt((1 + cosine) / 2) - 0.1, 0.01):
        inside = at >= cap
        t, weight = at[inside], first[inside]
        need = (cap - cosine * t) / np.maximum(np.sqrt((1 - cosine**2) * (1 - t**2)), 1e-12)
        alone, both = weight.sum(), (weight * np.interp(need, at, beyond, left=1, right=0)).sum()
        if both <= 0:
            break
        filters = SHARED / both
        codes = max(2, int(np.ceil(np.sqrt(filters / turns))))
        cost = filters * alone * (1 + MEET_COST * vectors * alone) + CODE_COST * turns * codes
        if best is None or cost < best[0]:
            best = cost, round(float(cap), 2), codes
    _CACHE[key] = best[1:]
    return best[1:]


class Filters:
    """The directions for vectors of one length."""

    def __init__(self, length: int, cap: float, codes: int, turns: int):
        self.cap, self.codes, self.length = cap, codes, length
        self.even = max(2, length + length % 2)
        half = self.even // 2
        rng = np.random.Generator(np.random.PCG64(length))
        self.turns = [np.linalg.qr(rng.normal(size=(self.even, self.even)))[0] for _ in range(turns)]
        self.words = []
        for _ in range(turns):
            words = rng.normal(size=(2, codes, half))
            self.words.append(words / np.linalg.norm(words, axis=2, keepdims=True) / np.sqrt(2))

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and filter of every exceeding direction, by row, then filter."""
        wide = np.zeros((len(unit), self.even))
        wide[:, : self.length] = unit
        rows, filters = [], []
        for turn, (q, words) in enumerate(zip(self.turns, self.words, strict=True)):
            y = wide @ q
            a, b = y[:, : self.even // 2] @ words[0].T, y[:, self.even // 2 :] @ words[1].T
            row, first = np.nonzero(a + b.max(axis=1, keepdims=True) >= self.cap)  # others can't exceed
            at, second = np.nonzero(a[row, first][:, None] + b[row] >= self.cap)
            rows.append(row[at])
            filters.append((turn * self.codes + first[at]) * self.codes + second)
        rows, filters = np.concatenate(rows), np.concatenate(filters)
        order = np.lexsort((filters, rows))
        return rows[order], filters[order]


def signs(unit: np.ndarray) -> np.ndarray:
    """The sketches of some unit vectors, as two 64-bit numbers each."""
    key = ("signs", unit.shape[1])
    if key not in _CACHE:
        _CACHE[key] = np.random.Generator(np.random.PCG64(unit.shape[1] + 7)).normal(size=(unit.shape[1], SIGNS))
    return np.packbits(unit @ _CACHE[key] > 0, axis=1, bitorder="little").view(np.int64)


def filters_of(length: int, cap: float, codes: int, turns: int) -> Filters:
    key = (length, cap, codes, turns)
    if key not in _CACHE:
        _CACHE[key] = Filters(*key)
    return _CACHE[key]


def units(column: pa.Array) -> np.ndarray | list[np.ndarray]:
    """Each vector as a double of length one: rows of one array where all are equally long, else a list."""
    bounds = np.concatenate(([0], np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)

    def scaled(v: np.ndarray) -> np.ndarray:
        v = v / np.abs(v).max(axis=-1, keepdims=True)
        return v / np.linalg.norm(v, axis=-1, keepdims=True)

    if len(column) and (np.diff(bounds) == bounds[1]).all():
        return scaled(flat.reshape(len(column), -1))
    return [scaled(flat[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _decode(cosine: float, vectors: int, cap: float | None, codes: int | None, turns: int):
    """Adds to each node the filters it belongs to and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = units(batch.column("embedding"))
            lengths = np.array([len(v) for v in rows])
            found: list = [None] * len(rows)
            sketch = np.zeros((len(rows), 2), np.int64)
            for length in np.unique(lengths).tolist():
                shape = shape_of(length, vectors, cosine, turns)
                filters = filters_of(length, cap or shape[0], codes or shape[1], turns)
                own = np.flatnonzero(lengths == length)
                # so many at a time that the inner products stay small
                some = max(16, (1 << 20) // (codes or shape[1]))
                for first in range(0, len(own), some):
                    part = own[first : first + some]
                    unit = np.array([rows[i] for i in part])
                    sketch[part] = signs(unit)
                    row, names = filters.decode(unit)
                    for i, mine in zip(part, np.split(names, np.searchsorted(row, np.arange(1, len(part)))), strict=True):
                        found[i] = mine
            more = [pa.array(found, pa.list_(pa.int64())), pa.array(sketch[:, 0]), pa.array(sketch[:, 1])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "filters", "s0", "s1"])

    return run


def hopeful(group: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Which rows have another row of their group at most ``FAR`` signs away; groups come one after the other."""
    out = np.zeros(len(group), bool)
    left = np.arange(len(group) - 1)
    apart = 1
    while len(left):
        left = left[left + apart < len(group)]
        left = left[group[left] == group[left + apart]]
        near = np.bitwise_count((sketch[left] ^ sketch[left + apart]).view(np.uint64)).sum(axis=1, dtype=np.int64) <= FAR
        out[left[near]] = True
        out[left[near] + apart] = True
        apart += 1
    return out


def _sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops the members of small filters without a partner by sketch; rows come sorted by filter, large filters pass."""
    waiting: pa.RecordBatch | None = None

    def sifted(rows: pa.RecordBatch) -> pa.RecordBatch:
        key = np.stack([rows.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("label", "length", "filter")])
        group = np.concatenate(([0], np.cumsum((key[:, 1:] != key[:, :-1]).any(axis=0))))
        small = rows.column("n").to_numpy() <= BLOCK
        keep = ~small
        at = np.flatnonzero(small)
        keep[at] = hopeful(group[at], np.column_stack([rows.column(c).to_numpy() for c in ("s0", "s1")])[at])
        return rows.drop_columns(["s0", "s1"]).filter(pa.array(keep))

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if waiting is None else pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0]
        last = [rows.column(c)[-1].as_py() for c in ("label", "length", "filter")]
        cut = rows.num_rows
        # a small filter that may go on in the next batch waits, at most BLOCK rows
        if rows.column("n")[-1].as_py() <= BLOCK:
            while cut and cut > rows.num_rows - BLOCK and [rows.column(c)[cut - 1].as_py() for c in ("label", "length", "filter")] == last:
                cut -= 1
        waiting = rows.slice(cut)
        if cut:
            yield sifted(rows.slice(0, cut))
    if waiting is not None and waiting.num_rows:
        yield sifted(waiting)


def _pair(cosine: float, filter: int, apart: bool, node, code, copies, side, unit, filters) -> list[tuple[int, int, int, int]]:
    """Links inside one block of a filter, or between two (``apart``): per linked node its links and an edge."""
    near = unit @ unit.T >= cosine
    if apart:
        near &= side[:, None] != side[None, :]
    np.fill_diagonal(near, False)
    some = np.flatnonzero(near.any(axis=1))
    if not len(some):
        return []
    near, node, code, copies = near[np.ix_(some, some)], node[some], code[some], copies[some]
    # a pair that shares a smaller filter counts there
    found = [filters[i] for i in some]
    at, found = np.repeat(np.arange(len(some)), [len(f) for f in found]), np.concatenate(found)
    lower = found < filter
    names, place = np.unique(found[lower], return_inverse=True)
    has = np.zeros((len(some), len(names)), np.float32)
    has[at[lower], place] = 1
    links = (near & ~(has @ has.T > 0)) @ copies
    order = np.argsort(node, kind="stable")
    rank = np.empty(len(some), np.int64)
    rank[order] = np.arange(len(some))
    least = rank.copy()
    while True:
        now = np.minimum(least, np.where(near, least[None, :], len(some)).min(axis=1))
        if (now == least).all():
            break
        least = now
    return list(zip(node.tolist(), code.tolist(), links.tolist(), node[order][least].tolist(), strict=True))


def _meet(cosine: float):
    """Compares the members of each pair of blocks; rows come sorted by pair of blocks."""
    schema = pa.schema([(name, pa.int64()) for name in ("node", "code", "links", "other")])
    keys, values = ("label", "length", "filter", "x", "y"), ("node", "code", "copies", "side")

    def joined(parts: list[tuple]) -> list[tuple[int, int, int, int]]:
        key = parts[0][0]
        if sum(len(p[1]) for p in parts) < 2:
            return []
        columns = [np.concatenate([p[i] for p in parts]) for i in range(1, 6)]
        return _pair(cosine, key[2], key[3] != key[4], *columns, [f for p in parts for f in p[6]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_parts: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            out = []
            key = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in keys])
            node, code, copies, side = (batch.column(c).to_numpy(zero_copy_only=False) for c in values)
            vectors = units(batch.column("embedding"))
            names = batch.column("filters")
            flat, ends = names.flatten().to_numpy(), np.cumsum(pc.list_value_length(names).to_numpy())
            filters = np.split(flat, ends[:-1])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                now = tuple(key[:, a].tolist())
                if open_parts and open_parts[0][0] != now:
                    out += joined(open_parts)
                    open_parts = []
                open_parts.append((now, node[a:b], code[a:b], copies[a:b], side[a:b], np.asarray(vectors[a:b]), filters[a:b]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)
        out = joined(open_parts) if open_parts else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)

    return run


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, cap: float | None = None, codes: int | None = None, turns: int = TURNS
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept (vec_id = component_id).

    ``cap`` and ``codes`` come from ``shape_of`` where not given.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), "embedding")
    sound = F.forall("embedding", lambda v: F.isnotnull(v) & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = F.isnotnull("vec_id") & F.isnotnull("label") & sound & F.exists("embedding", lambda v: v != 0)
    nodes = materialise(
        rows.where(usable).groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
        .withColumn("code", F.xxhash64("label", "embedding")), "nodes"
    )
    most = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    # rounded up to a power of two, so that nearly equal tables have the same filters
    most = 1 << max(0, most - 1).bit_length()
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    nodes = materialise(nodes.mapInArrow(_decode(cosine, most, cap, codes, turns), f"{kinds}, filters array<bigint>, s0 bigint, s1 bigint"), "filters")
    member = nodes.select("label", F.size("embedding").alias("length"), F.explode("filters").alias("filter"), "node", "code", "s0", "s1")
    key = ["label", "length", "filter"]
    sizes = member.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    placed = member.join(sizes, key).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.drop("s0", "s1").schema)
    placed = placed.repartition(*key, "own").sortWithinPartitions(*key).mapInArrow(_sift, kinds)
    meeting = F.explode(
        F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda j: F.struct(F.least("own", j).alias("x"), F.greatest("own", j).alias("y"), (F.col("own") <= j).alias("side")),
        )
    ).alias("m")
    work = placed.select(*key, "node", "code", meeting).select(*key, "m.x", "m.y", "m.side", "node", "code")
    content = nodes.select("label", "node", "code", "copies", "embedding", "filters")
    work = work.join(content, ["label", "node", "code"]).select(*key, "x", "y", "side", "node", "code", "copies", "embedding", "filters")
    blocks = [*key, "x", "y"]
    met = work.repartition(*blocks).sortWithinPartitions(*blocks).mapInArrow(_meet(cosine), "node bigint, code bigint, links bigint, other bigint")
    met = materialise(met, "met")
    comps = components(met.select(F.col("node").alias("a"), F.col("other").alias("b")))
    links = met.groupBy("node", "code").agg(F.sum("links").alias("links"))
    linked = nodes.join(links, ["node", "code"], "left").join(comps, "node", "left").select(
        F.col("label").alias("of"), F.col("embedding").alias("same"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
        F.coalesce("component", "node").alias("component"),
    )
    on = (rows["label"] == linked["of"]) & (rows["embedding"] == linked["same"])
    at = F.when(F.isnotnull("vec_id"), F.coalesce("component", "vec_id"))
    found = rows.join(linked, on, "left").select(
        "vec_id", F.when(F.isnotnull("vec_id"), F.coalesce("links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"), at.alias("component_id")
    )
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
