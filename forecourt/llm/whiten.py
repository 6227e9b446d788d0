"""Embedding whitening by Jacobi-Davidson.

Every entry c of a vector becomes x = floor(1024 c) + 100000. The leading eigenvectors of the covariance V of the x-vectors
are found without ever forming V:

* ``Centred.product`` multiplies V with a few vectors by one pass over the table: each task centres its rows,
  multiplies them twice and adds up; the parts, one number per entry, are added by Spark.
* The outer loop is a subspace Rayleigh-Ritz: of the wanted Ritz pairs, those whose residual has reached double precision are
  locked, in order; each other one gets a correction t from

      (I - B B') (V - theta I) (I - B B') t = -r,   B = locked vectors and current Ritz vectors,

  solved only roughly by MINRES. All inner solvers step together, so one step is one pass, whatever the number of
  pairs. The corrections extend the subspace, which restarts from its best Ritz vectors when it is full.
* A last Rayleigh-Ritz over the locked vectors settles the order and the eigenvalues.

The driver holds vectors of one length d, ``SPACE`` times the number of components at most; never V. The rows
are written once as blocks of small integers, which every pass reads.

Sums S of x are exact (whole numbers of any size), and rows are centred as (x - m) - f with m = floor(S / n) and f = S / n - m, so nothing
is lost to the size of x. Rows whose vector is null, empty or holds null or non-finite entries are dropped, as are those with entries beyond
2**52, which have no x in 64 bits, and those of another length than most rows have (of equally frequent lengths
the greatest counts). Components whose eigenvalue is not above rounding (``RANK`` of the greatest) are left out: rows without variance give
no result, as does the empty table. Repeated rows and ids, and null ids, are rows like any other; equal eigenvalues give any base of
their space, the same for all rows. ``deviation`` is null where it has more than 38 digits. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.session import materialise

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
BLOCK = 2048
#: Residuals below this part of the greatest eigenvalue have reached double precision.
TOLERANCE = 32 * np.finfo(float).eps
#: Residuals that have stopped falling must be below this part of it.
STALLED = 1e-12
RANK = 1e-14
#: Columns of the first subspace and of the largest one, per component.
FIRST, SPACE = 2, 6
INNER = 6
ROUNDS = 200


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of up to ``BLOCK`` vectors: ids, x - SHIFT as integers of the least size, and that size."""
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK):
            part = batch.slice(first, BLOCK)
            x = part.column("x").flatten().to_numpy()
            most = int(np.abs(x).max()) if len(x) else 0
            size = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
            ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("vec_id"))
            data = pa.array([x.astype(f"i{size}").tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, pa.array([size], pa.int32()), data], names=["ids", "size", "x"])


def _blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The ids of each block and its vectors less SHIFT, a row each."""
    for batch in batches:
        for ids, size, x in zip(batch.column("ids"), batch.column("size").to_pylist(), batch.column("x"), strict=True):
            yield ids.values, np.frombuffer(x.as_buffer(), f"i{size}").reshape(-1, length)


def packed(vectors: DataFrame) -> tuple[DataFrame, int]:
    """The written blocks of the rows that are not dropped, and the length of their vectors (0: no rows)."""
    c = F.transform("embedding", lambda v: v.cast("double"))
    fine = F.forall(c, lambda v: F.isnotnull(v) & ~F.isnan(v) & (F.abs(v) < float(1 << 52)))
    rows = vectors.select(F.col("vec_id").cast("bigint"), "embedding").where(fine & (F.size("embedding") > 0))
    most = rows.groupBy(F.size("embedding").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    length = most["length"] if most else 0
    x = F.transform("embedding", lambda v: F.floor(F.lit(float(SCALE)) * v.cast("double")).cast("bigint"))
    kept = rows.where(F.size("embedding") == length).select("vec_id", x.alias("x"))
    return materialise(kept.mapInArrow(_pack, "ids array<bigint>, size int, x binary"), "vectors"), length


class Centred:
    """The table of vectors, centred; every method is one pass over it."""

    def __init__(self, blocks: DataFrame, length: int):
        self.blocks, self.length, self.passes = blocks, length, 0
        self.n, self.sums = self._sums()
        self.low = np.array([s // max(self.n, 1) for s in self.sums])  # of x - SHIFT
        self.rest = np.array([float(s % max(self.n, 1)) / max(self.n, 1) for s in self.sums])

    def _sums(self) -> tuple[int, list[int]]:
        """Rows and exact sums, in halves that no task can overflow."""
        length = self.length

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            high, low = np.zeros(length + 1, np.int64), np.zeros(length + 1, np.int64)
            for _, x in _blocks(batches, length):
                x = x.astype(np.int64)
                high[:length] += (x >> 32).sum(axis=0)
                low[:length] += (x & 0xFFFFFFFF).sum(axis=0)
                low[length] += len(x)
            columns = [np.arange(length + 1), high, low]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["at", "high", "low"])

        parts = self.blocks.mapInArrow(run, "at bigint, high bigint, low bigint").groupBy("at")
        rows = sorted(tuple(r) for r in parts.agg(F.sum("high"), F.sum("low")).collect())  # length + 1 rows
        total = [(high << 32) + low for _, high, low in rows] or [0] * (length + 1)
        return total[-1], total[:-1]

    def added(self, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """The sum over all blocks of ``part`` of the centred rows, an array of ``size`` numbers."""
        length, low, rest = self.length, self.low, self.rest

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for _, x in _blocks(batches, length):
                total += part((x - low) - rest).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["at", "value"])

        self.passes += 1
        sums = self.blocks.mapInArrow(run, "at bigint, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
        out = np.zeros(size)
        out[sums["at"].to_numpy()] = sums["value"].to_numpy()
        return out

    def product(self, u: np.ndarray) -> np.ndarray:
        """V u, centred before multiplying."""
        return self.added(lambda x: x.T @ (x @ u), u.size).reshape(u.shape) / self.n

    def trace(self) -> float:
        return float(self.added(lambda x: np.square(x).sum(), 1)[0]) / self.n

    def covariance(self, u: np.ndarray) -> np.ndarray:
        """That of the rows' coordinates u' (x - S / n), themselves centred before multiplying."""
        k = u.shape[1]
        mean = self.added(lambda x: (x @ u).sum(axis=0), k) / self.n

        def part(x: np.ndarray) -> np.ndarray:
            y = x @ u - mean
            return y.T @ y

        return self.added(part, k * k).reshape(k, k) / self.n


def minres(product: Callable, shift: np.ndarray, base: np.ndarray, right: np.ndarray, tolerance: np.ndarray, steps: int) -> np.ndarray:
    """Rough solutions of (I - BB')(V - shift)(I - BB') t = right, a column each, B = base; all step together."""
    project = lambda y: y - base @ (base.T @ y)
    right = project(right)
    t = np.zeros_like(right)
    first = np.linalg.norm(right, axis=0)
    active = np.flatnonzero(first > 0)
    old, now = right[:, active].copy(), right[:, active].copy()
    y, beta, last = now, first[active].copy(), np.ones(len(active))
    delta_bar, epsilon, left = np.zeros(len(active)), np.zeros(len(active)), beta.copy()
    cs, sn = -np.ones(len(active)), np.zeros(len(active))
    w, w_old = np.zeros_like(now), np.zeros_like(now)
    for step in range(steps):
        if not len(active):
            break
        v = y / beta
        y = project(product(project(v)) - v * shift[active])
        if step:
            y -= old * (beta / last)
        alpha = (v * y).sum(axis=0)
        y -= now * (alpha / beta)
        old, now, last, beta = now, y, beta, np.linalg.norm(y, axis=0)
        before, delta = epsilon, cs * delta_bar + sn * alpha
        gamma_bar = sn * delta_bar - cs * alpha
        epsilon, delta_bar = sn * beta, -cs * beta
        gamma = np.maximum(np.hypot(gamma_bar, beta), 1e-300)
        cs, sn = gamma_bar / gamma, beta / gamma
        w, w_old = (v - w_old * before - w * delta) / gamma, w
        t[:, active] += w * (cs * left)
        left = sn * left
        go = (left > tolerance[active] * first[active]) & (beta > 1e-14 * np.abs(alpha))
        if not go.all():
            active = active[go]
            old, now, y, w, w_old = (a[:, go] for a in (old, now, y, w, w_old))
            beta, last, left, cs, sn, epsilon, delta_bar = (a[go] for a in (beta, last, left, cs, sn, epsilon, delta_bar))
    return project(t)


def extended(space: np.ndarray, locked: np.ndarray, new: np.ndarray) -> np.ndarray:
    """An orthonormal base of what the new vectors add to the space and the locked vectors."""
    kept = np.empty((len(new), 0))
    for column in new.T:
        size = np.linalg.norm(column)
        for _ in range(3):
            for base in (locked, space, kept):
                column = column - base @ (base.T @ column)
        if size and np.linalg.norm(column) > 1e-10 * size:
            kept = np.column_stack((kept, column / np.linalg.norm(column)))
    return kept


def eigenpairs(product: Callable[[np.ndarray], np.ndarray], length: int, wanted: int, inner: int = INNER) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues, falling, and their unit eigenvectors, a column each."""
    wanted = min(wanted, length)
    rng = np.random.Generator(np.random.PCG64(17))
    locked = np.empty((length, 0))
    space = extended(locked, locked, rng.normal(size=(length, min(length, FIRST * wanted))))
    image = product(space)
    best, stalled, scale = np.full(wanted, np.inf), 0, 0.0
    for turn in range(ROUNDS):
        values, mix = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
        order = np.argsort(-values)
        values, mix = values[order], mix[:, order]
        space, image = space @ mix, image @ mix
        scale = max(scale, float(np.abs(values).max(initial=0)))
        left = min(wanted - locked.shape[1], space.shape[1])
        ritz, theta = space[:, :left], values[:left]
        residual = image[:, :left] - ritz * theta
        residual -= locked @ (locked.T @ residual)
        sizes = np.linalg.norm(residual, axis=0)
        # no further in three rounds: rounding of the products is all that is left
        stalled = 0 if (sizes < 0.5 * best[-left:]).any() else stalled + 1
        best[-left:] = np.minimum(best[-left:], sizes)
        small = sizes <= (TOLERANCE if stalled < 3 else STALLED) * scale
        done = left if small.all() else int(np.argmin(small))
        if done:
            locked = np.column_stack((locked, ritz[:, :done]))
            space, image = space[:, done:], image[:, done:]
            image = image - locked @ (locked.T @ image)
            ritz, theta, residual, sizes = ritz[:, done:], theta[done:], residual[:, done:], sizes[done:]
        if locked.shape[1] == wanted:
            break
        if stalled > 10:
            raise ArithmeticError(f"residuals stay at {sizes.max() / scale:.1e} of the greatest eigenvalue")
        some = np.flatnonzero(sizes > TOLERANCE * scale)
        if not len(some):
            some = np.arange(len(sizes))
        base = np.column_stack((locked, ritz))
        rough = np.maximum(np.full(len(some), 0.5 ** (turn + 2)), TOLERANCE * scale / np.maximum(sizes[some], 1e-300) / 4)
        t = minres(product, theta[some], base, -residual[:, some], rough, inner)
        if space.shape[1] + len(some) > SPACE * wanted:
            space, image = space[:, : FIRST * wanted], image[:, : FIRST * wanted]
        new = extended(space, locked, t)
        if new.shape[1]:
            space, image = np.column_stack((space, new)), np.column_stack((image, product(new)))
    else:
        raise ArithmeticError("no double precision after so many rounds")
    values, mix = np.linalg.eigh((lambda a: (a + a.T) / 2)(locked.T @ product(locked)))
    order = np.argsort(-values)
    vectors = locked @ mix[:, order]
    vectors /= np.linalg.norm(vectors, axis=0)
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)])
    return values[order], vectors * np.where(sign == 0, 1, sign)


WHITENED = (
    "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
)
_WHITENED = pa.schema(
    [("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.decimal128(38)),
     ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())]
)
_MOST = 10**38


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[Decimal | None]:
    """Sum over the entries of (n x - S) ** 2, exact."""
    most = max((int(np.abs(x.astype(np.int64)).max()) if x.size else 0) * n + max(map(abs, sums)), 1)
    if most < 1 << 62 and most * most * len(sums) < 1 << 63:
        d = x.astype(np.int64) * n - np.array(sums, np.int64)
        found = (d * d).sum(axis=1).tolist()
    else:
        d = x.astype(object) * n - np.array(sums, object)
        found = [int(v) for v in (d * d).sum(axis=1)]
    return [Decimal(v) if v < _MOST else None for v in found]


def projected(x: np.ndarray, u: np.ndarray) -> np.ndarray:
    """x u, added up in one order whatever the number of rows, so equal rows give equal numbers to the last bit."""
    out = np.zeros((len(x), u.shape[1]))
    for column, weights in zip(x.T, u, strict=True):
        out += column[:, None] * weights
    return out


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per row (vec_id, embedding) that is not dropped and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    blocks, length = packed(vectors)
    none = vectors.sparkSession.createDataFrame([], WHITENED)
    if not length:
        return none
    table = Centred(blocks, length)
    trace = table.trace()
    if trace <= 0:
        return none
    values, u = eigenpairs(table.product, length, components)
    some = values > RANK * values[0]
    values, u = values[some], u[:, some] / np.sqrt(values[some])
    error = float(np.abs(table.covariance(u) - np.eye(len(values))).max())
    n, sums, low, rest, k = table.n, table.sums, table.low, table.rest, len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, length):
            rows = len(x)
            times = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(times)), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()), pa.array(np.full(rows * k, n)),
                    pa.array(deviations(x, n, sums), pa.decimal128(38)).take(pa.array(times)), pa.array(projected((x - low) - rest, u).ravel()),
                    pa.array(np.tile(values / trace, rows)), pa.array(np.full(rows * k, error)),
                ],
                schema=_WHITENED,
            )

    return blocks.mapInArrow(run, WHITENED)
