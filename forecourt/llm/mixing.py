"""Mixing sources to target weights by cube-method balanced sampling.

Targets: the sources, ordered by code point with null last, weigh 5, 2, 1, repeating, and share
``BUDGET`` times all words. A target stops at ``MOST`` times its source's words; the excess is
reshared by weight among the others until none is above.

A source's ratio of target to words, at most 2, is a whole number of copies for all of its documents
plus a fraction f that each is included once more with. Which ones is decided by the
cube method: the fractional probabilities of three documents at a time move along the null
space of the balancing constraints (number of documents, number of words) until one becomes 0 or 1.
The flight runs in cells of a source, in parallel and in constant memory; each cell leaves at
most two fractional documents, which meet again in fewer cells, until a source has one. There the
flight ends with a landing of these two and ``WAITING`` more that were kept back: of all their subsets the one
nearest to both constraints is taken.

The random numbers of a cell depend on its source and number only and documents are taken in
order of their ids, so reruns agree. Rows with equal doc_id, source and text are one unit
with the words of all of them. Null texts have size 0; sources without words have target 0;
null ids, null sources and empty tables are allowed. Other columns pass through ``mixed`` and are ignored otherwise.

One row per source goes through the ranking of sources; documents are never gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.session import materialise

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST = 2
#: A run of characters outside white space. [fixed value]
WORD = r"[^\x20\x09-\x0D]+"
CELL_ROWS = 4096
_NEAR = 1e-9
#: Documents of a source that wait for the landing, where all their subsets are weighed.
WAITING = 14

_UNIT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("row_key", T.LongType()),
        T.StructField("size", T.LongType()), T.StructField("rows", T.LongType()), T.StructField("chance", T.DoubleType()),
        T.StructField("cell", T.LongType()), T.StructField("cells", T.LongType()),
    ]
)


def sizes(docs: DataFrame) -> DataFrame:
    """One row per unit: doc_id, source, row_key, size (words of one row), rows."""
    text = F.col("text")
    return (
        docs.select(
            F.col("doc_id").cast("bigint"), F.col("source").cast("string"), F.xxhash64("text").alias("row_key"),
            F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit(WORD))).cast("bigint").alias("size"),
        )
        .groupBy("doc_id", "source", "row_key", "size").agg(F.count(F.lit(1)).alias("rows"))
    )


def targets(units: DataFrame) -> DataFrame:
    """One row per source: source, source_size, units, target."""
    spark = units.sparkSession
    per_source = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("units"))
    schema = T.StructType(
        [T.StructField("source", T.StringType()), T.StructField("source_size", T.LongType()), T.StructField("units", T.LongType()), T.StructField("weight", T.DoubleType())]
    )
    ordered = materialise(per_source.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last()), "sources")
    ranked = ordered.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex()
    weighted = materialise(spark.createDataFrame(ranked.map(lambda x: (*x[0], float(WEIGHTS[x[1] % len(WEIGHTS)]))), schema), "weights")
    share, most = 0.0, F.col("source_size") * MOST
    capped = F.lit(False)
    while True:
        row = weighted.agg(
            F.sum("source_size"),
            F.sum(F.when(capped, F.col("source_size") * MOST).otherwise(0)),
            F.sum(F.when(~capped, F.col("weight")).otherwise(0.0)),
        ).first()
        if not row[0] or not row[2]:
            break
        now = (BUDGET * row[0] - row[1]) / row[2]
        if now <= share:
            break
        share = now
        capped = F.col("weight") * F.lit(share) >= most
    target = F.least(F.col("weight") * F.lit(share), most.cast("double"))
    return materialise(weighted.select("source", "source_size", "units", target.alias("target")), "targets")


class Flight:
    """The flight phase over a run of (key, size, chance); three documents are in the air."""

    def __init__(self, seed: bytes, waiting: int = 0):
        self.rng = np.random.Generator(np.random.PCG64(crc32(seed)))
        self.air: list[list] = []
        self.held: list[list] = []
        self.waiting = waiting

    def add(self, row: tuple, size: int, chance: float) -> Iterator[tuple[tuple, float]]:
        if chance <= _NEAR or chance >= 1 - _NEAR:
            yield row, float(round(chance))
            return
        if len(self.held) < self.waiting:
            self.held.append([row, float(size), chance])
            return
        self.air.append([row, float(size), chance])
        if len(self.air) == 3:
            a, b, c = (x[1] for x in self.air)
            way = (b - c, c - a, a - b) if not a == b == c else (1.0, -1.0, 0.0)
            yield from self._move(way)

    def _move(self, way: tuple) -> Iterator[tuple[tuple, float]]:
        up = min(((1 - x[2]) / w if w > 0 else x[2] / -w) for x, w in zip(self.air, way, strict=True) if w)
        down = min((x[2] / w if w > 0 else (1 - x[2]) / -w) for x, w in zip(self.air, way, strict=True) if w)
        step = up if self.rng.random() * (up + down) < down else -down
        left = []
        for x, w in zip(self.air, way, strict=True):
            x[2] = min(1.0, max(0.0, x[2] + step * w))
            if _NEAR < x[2] < 1 - _NEAR:
                left.append(x)
            else:
                yield x[0], float(round(x[2]))
        self.air = left

    def rest(self) -> Iterator[tuple[tuple, float]]:
        yield from ((x[0], x[2]) for x in self.air)
        self.air = []

    def land(self) -> Iterator[tuple[tuple, float]]:
        left = self.held + self.air
        words, chances = np.array([x[1] for x in left]), np.array([x[2] for x in left])
        subsets = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
        miss = np.abs((subsets - chances) @ words) + np.abs((subsets - chances).sum(axis=1))
        best = subsets[int(miss.argmin())] if left else ()
        yield from ((x[0], float(taken)) for x, taken in zip(left, best, strict=True))
        self.air, self.held = [], []


def _fly(last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, flight = None, None
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            out = []
            for row in rows:
                key = (row[1], row[6])
                if key != now or flight is None:
                    if flight:
                        out += flight.land() if last else flight.rest()
                    now, flight = key, Flight(f"{row[7]}/{row[6]}/{row[1]}".encode(), WAITING if last else 0)
                out += flight.add(row, row[3] * row[4], row[5])
            if out:
                yield _rows(out, batch.schema)
        if flight and (out := list(flight.land() if last else flight.rest())):
            yield _rows(out, batch.schema)

    return run


def _rows(out: list, schema: pa.Schema) -> pa.RecordBatch:
    rows = zip(*((*row[:5], chance, *row[6:]) for row, chance in out), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)


def mix(docs: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per unit: doc_id, source, row_key, size, rows, source_size, target, copies."""
    units = materialise(sizes(docs), "sizes")
    goal = targets(units)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    same = units["source"].eqNullSafe(goal["source"])
    joined = units.join(goal, same).select(
        units["doc_id"], units["source"], "row_key", "size", "rows", (ratio - F.floor(ratio)).alias("chance"),
        F.greatest(F.lit(1), F.ceil(F.col("units") / cell_rows)).cast("bigint").alias("cells"),
    )
    number = F.pmod(F.xxhash64("doc_id", "row_key"), F.col("cells"))
    rest = joined.withColumn("cell", number)
    done = None
    while True:
        most = rest.agg(F.max("cells")).first()[0]
        last = most is None or most <= 1
        flown = rest.select(*_UNIT.names).repartition("source", "cell").sortWithinPartitions("source", "cell", "doc_id", "row_key", "size")
        flown = materialise(flown.mapInArrow(_fly(last), _UNIT), "flight")
        settled = flown.where("chance in (0.0, 1.0)")
        done = settled if done is None else done.union(settled)
        if last:
            break
        # at most two are left of each cell
        cells = F.greatest(F.lit(1), F.ceil(F.col("cells") * 2 / cell_rows)).cast("bigint")
        rest = flown.where("chance not in (0.0, 1.0)").withColumn("cells", cells).withColumn("cell", number)
    same = done["source"].eqNullSafe(goal["source"])
    copies = (F.floor(ratio) + F.col("chance")).cast("bigint").alias("copies")
    return done.join(goal, same).select("doc_id", done["source"], "row_key", "size", "rows", "source_size", "target", copies)


def mixture(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, size, source_size, target, taken (words, repeats counted)."""
    return mix(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))).alias("n"),
    ).drop("n")


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns and, at the end, how often to take each: ``copies`` (1 or more).

    A column of that name in ``docs`` is replaced.
    """
    chosen = mix(docs).where("copies > 0").select(F.col("doc_id").alias("id_"), F.col("source").alias("source_"), "row_key", F.col("copies").alias("times"))
    kept = [c for c in docs.columns if c.lower() != "copies"]
    row = F.struct(*[F.col(f"`{c}`") for c in kept])
    keyed = docs.select(row.alias("row"), F.col("doc_id").cast("bigint").alias("id"), F.col("source").cast("string").alias("of"), F.xxhash64("text").alias("text_key"))
    on = keyed["id"].eqNullSafe(chosen["id_"]) & keyed["of"].eqNullSafe(chosen["source_"]) & (keyed["text_key"] == chosen["row_key"])
    return keyed.join(chosen, on).select("row.*", F.col("times").alias("copies"))
