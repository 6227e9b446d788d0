"""MinHash near-dedup: banded universal hash minima, signature check, exact check, components.

Words are runs outside white space with A-Z lowered; a document's set holds its distinct
``k``-word shingles, or its whole word sequence if it has fewer words. Documents are linked when
100 * intersection >= ``percent`` * union of their sets; without words they link with nothing.

1. Every document gets ``HASHES`` minima and a digest of its words. Documents with one digest
   (copies) become one node; hot groups of copies are folded before the shuffle.
2. Nodes that agree on one of ``BANDS`` bands of ``ROWS`` minima share a bucket; at a similarity of 0.8 a
   pair shares none with a chance of 0.2 %, at 0.85 of 0.008 %. Buckets with the same members count once.
3. Each member is compared with the smallest member of its bucket: first the signatures,
   then the whole sets. The links found give components.
4. Only buckets that still hold several components are searched further, in blocks of members
   against blocks of members, signatures first, whole sets after; pairs inside one component
   are skipped, and blocks of the largest component never meet each other. What they link
   joins the components. So no link that a bucket holds is lost to the components, and a
   large group of copies costs its size, not its square.

Rows with one doc_id are one document: it has the links of all of them. Rows without a
doc_id link with nothing: their component is null and they are kept. Other columns are ignored by ``near_duplicates``; ``one_of_each``
passes them on. The empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm import common
from forecourt.llm.components import components
from forecourt.operators.skew import group_apart
from forecourt.session import materialise

K = 5
PERCENT = 80
BANDS, ROWS = 20, 6
HASHES = BANDS * ROWS
#: The estimate of a linked pair lies below its similarity less this once in 100,000 times.
SLACK = 0.16
BLOCK = 256

_SIGNED = pa.schema(
    [("doc_id", pa.int64()), ("digest", pa.binary()), ("n_shingles", pa.int64()), ("signature", pa.list_(pa.int32()))]
)
SIGNED = "doc_id bigint, digest binary, n_shingles bigint, signature array<int>"
_SETS = pa.schema([("id", pa.int64()), ("signature", pa.list_(pa.int32())), ("grams", pa.list_(pa.int64()))])
SETS = "id bigint, signature array<int>, grams array<bigint>"
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def family(count: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-shift hash functions of 32-bit values, universal in their high half."""
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(0, 1 << 64, (count, 1), np.uint64) | np.uint64(1), rng.integers(0, 1 << 64, (count, 1), np.uint64)


_A, _B = family(HASHES)


def signature(grams: np.ndarray) -> np.ndarray:
    low = None
    for first in range(0, len(grams), 4096):
        now = (_A * (grams[None, first : first + 4096] >> np.uint64(32)) + _B).min(axis=1)
        low = now if low is None else np.minimum(low, now)
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _documents(column: pa.Array, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The word hashes and the sorted distinct shingles of every text."""
    data, bounds = common.buffers(column)
    for first, last, words, at in common.words_of_rows(data, bounds):
        grams, where = common.shingle_hashes(words, at, k)
        for row in range(last - first):
            yield words[at[row] : at[row + 1]], np.unique(grams[where[row] : where[row + 1]])


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, minima = [], [], []
            for words, grams in _documents(batch.column("text"), k):
                sizes.append(len(grams))
                digests.append(hashlib.blake2b(words.tobytes(), digest_size=16).digest() if len(words) else None)
                minima.append(signature(grams) if len(words) else np.empty(0, np.int32))
            bounds = np.concatenate(([0], np.cumsum([len(m) for m in minima])))
            values = np.concatenate(minima) if minima else np.empty(0, np.int32)
            columns = [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), common.lists(values, bounds, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, schema=_SIGNED)

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [g for _, g in _documents(batch.column("text"), k)]
            if not grams:
                continue
            full = [bool(len(g)) for g in grams]
            minima = [signature(g) for g in grams if len(g)]
            grams = [g for g in grams if len(g)]
            if not grams:
                continue
            ids = batch.column("id").filter(pa.array(full))
            columns = [
                ids, common.lists(np.concatenate(minima), np.arange(len(grams) + 1) * HASHES, pa.int32()),
                common.lists(np.concatenate(grams).view(np.int64), np.concatenate(([0], np.cumsum([len(g) for g in grams]))), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=_SETS)

    return run


def linked(a: int, b: int, shared: int, percent: int) -> bool:
    return 100 * shared >= percent * (a + b - shared)


def _search(percent: int):
    """Links between different components inside one pair of blocks; see step 4."""
    floor = HASHES * (percent / 100 - SLACK)

    def pairs(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        ids, comps, sides, minima, grams = zip(*rows, strict=True)
        minima = np.array(minima, np.int32)
        sets = [np.array(g, np.int64).view(np.uint64) for g in grams]
        sizes = np.array([len(s) for s in sets])
        parent: dict[int, int] = {}

        def root(c: int) -> int:
            while parent.setdefault(c, c) != c:
                parent[c] = c = parent[parent[c]]
            return c

        left = [i for i, s in enumerate(sides) if s]
        right = np.array([i for i, s in enumerate(sides) if not s] or left)
        apart = any(not s for s in sides)
        for i in left:
            others = right if apart else right[right > i]
            if not len(others):
                continue
            near = (minima[others] == minima[i]).sum(axis=1) >= floor
            near &= 100 * np.minimum(sizes[others], sizes[i]) >= percent * np.maximum(sizes[others], sizes[i])
            for j in others[near]:
                a, b = root(comps[i]), root(comps[j])
                if a != b:
                    shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if linked(len(sets[i]), len(sets[j]), shared, percent):
                        parent[max(a, b)] = min(a, b)
                        yield ids[i], ids[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("h", "x", "y", "id", "comp", "side", "signature", "grams"))
            out = []
            for h, x, y, *row in zip(*columns, strict=True):
                if (h, x, y) != now:
                    out += pairs(rows) if len(rows) > 1 else ()
                    now, rows = (h, x, y), []
                rows.append(row)
            if out:
                yield common.batch_of({"a": [p[0] for p in out], "b": [p[1] for p in out]}, _LINKS)
        if len(rows) > 1 and (out := list(pairs(rows))):
            yield common.batch_of({"a": [p[0] for p in out], "b": [p[1] for p in out]}, _LINKS)

    return run


def _star_links(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass the signature check and the exact check."""
    a = sets.toDF("a", "a_signature", "a_grams")
    b = sets.toDF("b", "b_signature", "b_grams")
    agree = F.aggregate(F.zip_with("a_signature", "b_signature", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    shared, both = F.size(F.array_intersect("a_grams", "b_grams")), F.size("a_grams") + F.size("b_grams")
    least, most = F.least(F.size("a_grams"), F.size("b_grams")), F.greatest(F.size("a_grams"), F.size("b_grams"))
    checked = F.when((100 * least >= percent * most) & (agree >= HASHES * (percent / 100 - SLACK)), 100 * shared >= percent * (both - shared))
    return stars.join(a, "a").join(b, "b").where(checked).select("a", "b")


def _further_links(members: DataFrame, comps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components that a bucket still holds (members: h, id)."""
    placed = materialise(
        members.join(comps.withColumnRenamed("node", "id"), "id", "left").select("h", "id", F.coalesce("component", "id").alias("comp")), "placed"
    )
    per_comp = placed.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = group_apart(
        per_comp, ["h"], F.max_by("comp", F.struct("n", "comp")).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_comps")
    ).where("n_comps > 1")
    blocks = placed.join(mixed, "h").select(
        "h", "id", "comp", (F.col("comp") != F.col("main")).alias("rest"),
        F.ceil(F.col("n_main") / BLOCK).cast("int").alias("mains"), F.ceil((F.col("n") - F.col("n_main")) / BLOCK).cast("int").alias("rests"),
    )
    own = F.pmod(F.xxhash64("id"), F.when(F.col("rest"), F.col("rests")).otherwise(F.col("mains"))).cast("int")
    blocks = blocks.withColumn("own", own)
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    entry = lambda x, y, side: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), side.alias("side"))
    rest_rest = F.transform(upto("rests"), lambda j: entry(F.least("own", j), F.greatest("own", j), F.col("own") <= j))
    rest_main = F.transform(upto("mains"), lambda j: entry(F.col("own"), -1 - j, F.lit(True)))
    main_rest = F.transform(upto("rests"), lambda i: entry(i, -1 - F.col("own"), F.lit(False)))
    where = F.explode(F.when(F.col("rest"), F.concat(rest_rest, rest_main)).otherwise(main_rest))
    work = blocks.select("h", "id", "comp", where.alias("w")).select("h", "w.x", "w.y", "id", "comp", "w.side").join(sets, "id")
    return work.repartition("h", "x", "y").sortWithinPartitions("h", "x", "y").mapInArrow(_search(percent), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id, kept (doc_id = component_id)."""
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    signed = materialise(texts.mapInArrow(_sign(k), SIGNED), "signed")
    nodes = signed.where("isnotnull(digest) and isnotnull(doc_id)").groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.first("signature").alias("signature")
    )
    nodes = materialise(nodes, "nodes")
    bands = F.array(*[F.xxhash64(F.lit(i), F.slice("signature", i * ROWS + 1, ROWS)) for i in range(BANDS)])
    banded = nodes.select("id", F.explode(bands).alias("h"))
    buckets = banded.groupBy("h").agg(
        F.min("id").alias("leader"), F.max("id").alias("top"), F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("who")
    ).where("leader < top").groupBy("leader", "top", "n", "who").agg(F.min("h").alias("h"))
    # written, so that the joins get their real size and Spark can split a hot bucket
    buckets = materialise(buckets.select("h", "leader", "n"), "buckets")
    members = materialise(banded.join(buckets, "h"), "members")
    stars = materialise(members.where("id <> leader").select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct(), "stars")
    needed = materialise(stars.select(F.col("a").alias("id")).union(stars.select(F.col("b").alias("id"))).distinct(), "needed")
    some = texts.withColumnRenamed("doc_id", "id").join(needed, "id", "left_semi")
    sets = materialise(some.mapInArrow(_sets(k), SETS), "sets")
    links = materialise(_star_links(stars, sets, percent), "star_links")
    further = _further_links(members.where("n > 2").select("h", "id"), components(links), sets, percent)
    comps = components(links.union(materialise(further, "further_links")))
    classes = nodes.join(comps.withColumnRenamed("node", "id"), "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    component = F.when(F.isnotnull("doc_id"), F.coalesce("component", "doc_id"))
    return signed.drop("signature").join(classes, "digest", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def one_of_each(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """The documents less all but one of each group, with all their columns.

    Of several rows with the doc_id that stays, the one with the smallest text stays (a null text comes
    last), of equal texts the one with the smallest hash of all columns. Rows without a doc_id stay.
    """
    kept = near_duplicates(docs, k, percent).where("kept and isnotnull(doc_id)").select(F.col("doc_id").alias("kept")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col("doc_id").cast("bigint").alias("id"), "text")
    stay = rows.join(kept, F.col("id") == F.col("kept"), "left_semi")
    order = Window.partitionBy("id").orderBy(F.asc_nulls_last("text"), F.xxhash64("row"))
    first = stay.withColumn("n", F.row_number().over(order)).where("n = 1")
    return first.select("row.*").union(docs.where("doc_id is null"))
