"""Operator 11: embedding whitening by a block Jacobi-Davidson method with distributed products.

*Vectors.* An entry c becomes the integer floor(1024 c) + 100000. Per-dimension sums are exact integers, and with their
quotient and remainder by the number of rows every centred entry is exact before it becomes a double.

*Products.* The covariance is never formed: its product with a few columns W is the sum over rows z of z (z W), made by
every task over its blocks of rows and added up by Spark, dimension by dimension. What the driver holds has as many
entries as a vector has dimensions, times the few columns.

*Eigenpairs.* Rayleigh-Ritz on the search space gives approximate pairs. Those whose residual has reached double precision
are locked, the first ones first. For the others the correction equations (the shifted covariance, projected off all
approximations) are solved by MINRES, all in step so that each step is one distributed product; the corrections widen the
search space, which starts again from its best part when it has become wide.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasekit.llm.common import written

SCALE, SHIFT = 1024, 100_000
#: Integers are held between these (about 4.4e12 in the embedding's own units).
FARTHEST = 1 << 52
#: Rows of a block, about; steps of MINRES on one set of correction equations, at most.
BLOCK_VALUES, INNER = 1 << 17, 4
_EPS = float(np.finfo(np.float64).eps)


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is not null and holds no null and no non-finite entry."""
    bad = F.exists(column, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.where(F.col(column).isNotNull() & ~bad)


def integers(column: pa.Array, dimensions: int) -> np.ndarray:
    """Rows of integer vectors; a shorter vector is filled up with entries of 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.clip(np.floor(SCALE * flat), -FARTHEST, FARTHEST - SHIFT).astype(np.int64) + SHIFT
    if len(lengths) and lengths.min() == dimensions:
        return x.reshape(-1, dimensions)
    out = np.full((len(lengths), dimensions), SHIFT, np.int64)
    out[np.arange(dimensions) < lengths[:, None]] = x
    return out


def blocks(vectors: DataFrame, column: str, dimensions: int) -> DataFrame:
    """``n, x``: the integer vectors in blocks of rows, as 64-bit little-endian numbers."""
    rows = max(1, BLOCK_VALUES // dimensions)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                x = integers(batch.column(0).slice(at, rows), dimensions)
                yield pa.record_batch([pa.array([len(x)], pa.int64()), pa.array([x.astype("<i8").tobytes()], pa.binary())], names=["n", "x"])

    return vectors.select(column).mapInArrow(make, "n long, x binary")


def _arrays(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for x in batch.column("x"):
            yield np.frombuffer(x.as_buffer(), "<i8").reshape(-1, dimensions)


class Moments:
    """Number of rows, exact sums, and centred rows of a table of :func:`blocks`."""

    def __init__(self, table: DataFrame, dimensions: int) -> None:
        self.table, self.dimensions = table, dimensions

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, high, low = 0, np.zeros(dimensions, np.int64), np.zeros(dimensions, np.int64)
            for x in _arrays(batches, dimensions):  # in two halves: no overflow
                n += len(x)
                high += (x >> 26).sum(0)
                low += (x & ((1 << 26) - 1)).sum(0)
            yield pa.record_batch([pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(np.full(dimensions, n)), pa.array(high), pa.array(low)], names=["at", "n", "high", "low"])

        whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
        sums = table.mapInArrow(add, "at int, n long, high long, low long").groupBy("at").agg(F.sum("n").alias("n"), whole("high"), whole("low")).collect()  # a row a dimension
        self.n = int(sums[0].n) if sums else 0
        self.sums = [0] * dimensions
        for s in sums:
            self.sums[s["at"]] = (int(s.high) << 26) + int(s.low)
        n = max(self.n, 1)
        self.quotient = np.array([s // n for s in self.sums], np.int64)
        self.remainder = [s % n for s in self.sums]

    def centre(self) -> Callable[[np.ndarray], np.ndarray]:
        """x - S / n as doubles: the quotient is taken off exactly."""
        quotient, part = self.quotient, np.array([r / max(self.n, 1) for r in self.remainder])
        return lambda x: (x - quotient).astype(np.float64) - part

    def deviation(self) -> Callable[[np.ndarray], list[Decimal]]:
        """Sum over dimensions of (n x - S)², exact."""
        n, quotient, remainder = self.n, self.quotient, self.remainder

        def exact(x: np.ndarray) -> list:
            near = x - quotient
            most = n * (int(np.abs(near).max()) + 1) if x.size else 0
            if most * most * max(len(remainder), 1) < 1 << 63:
                d = n * near - np.array(remainder, np.int64)
                return [Decimal(int(v)) for v in (d * d).sum(1)]
            return [Decimal(sum((n * int(v) - r) ** 2 for v, r in zip(row, remainder))) for row in near]

        return exact

    def summed(self, kernel: Callable[[np.ndarray], np.ndarray], rows: int, columns: int) -> np.ndarray:
        """The sum of ``kernel(centred rows)``, a matrix of ``rows`` x ``columns``, over all blocks: one distributed pass."""
        centre, dimensions = self.centre(), self.dimensions

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((rows, columns))
            for x in _arrays(batches, dimensions):
                total += kernel(centre(x))
            yield pa.record_batch([pa.array(np.arange(rows, dtype=np.int32)), *(pa.array(total[:, k].copy()) for k in range(columns))], names=["at", *(f"v{k}" for k in range(columns))])

        kind = "at int, " + ", ".join(f"v{k} double" for k in range(columns))
        found = self.table.mapInArrow(add, kind).groupBy("at").agg(*(F.sum(f"v{k}").alias(f"v{k}") for k in range(columns))).collect()  # a row a dimension
        total = np.zeros((rows, columns))
        for row in found:
            total[row["at"]] = [row[f"v{k}"] for k in range(columns)]
        return total

    def product(self, w: np.ndarray) -> np.ndarray:
        """Covariance times the columns of ``w``."""
        return self.summed(lambda z: z.T @ (z @ w), *w.shape) / max(self.n, 1)

    def trace(self) -> float:
        return float(self.summed(lambda z: (z * z).sum(0)[:, None], self.dimensions, 1).sum()) / max(self.n, 1)


def _orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span ``new`` beside the bases; columns that depend on others are left out."""
    kept = np.zeros((len(new), 0))
    for column in new.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        v = column / size
        for _ in range(3):
            for basis in (*bases, kept):
                v = v - basis @ (basis.T @ v)
            left = np.linalg.norm(v)
            if left < 1e-10:
                break
            v = v / left
        else:
            kept = np.column_stack([kept, v])
    return kept


def minres(product: Callable[[np.ndarray], np.ndarray], shifts: np.ndarray, off: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, least: float) -> np.ndarray:
    """Approximate t with off (A - shift) t = right for each column, by MINRES (Lanczos and Givens rotations) on all
    columns in step: one product a step. ``off`` projects; the columns of ``right`` are projected already. A column stops
    when its residual has fallen by ``least``."""
    beta = np.linalg.norm(right, axis=0)
    alive = beta > 0
    v_old, v = np.zeros_like(right), right / np.where(alive, beta, 1)
    t, d, d_old = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    c, s, c_old, s_old = (np.full(len(beta), x) for x in (1.0, 0.0, 1.0, 0.0))
    rest, first, b = beta.copy(), beta.copy(), np.zeros(len(beta))
    for _ in range(steps):
        if not alive.any():
            break
        u = np.zeros_like(right)
        u[:, alive] = product(v[:, alive])
        u = off(u - v * shifts)
        a = (v * u).sum(0)
        u = off(u - a * v - b * v_old)
        b_new = np.linalg.norm(u, axis=0)
        epsilon, delta = s_old * b, c_old * b
        r2, r1 = c * delta + s * a, -s * delta + c * a
        r0 = np.hypot(r1, b_new)
        good = alive & (r0 > 0)
        safe = np.where(good, r0, 1)
        c_new, s_new = np.where(good, r1 / safe, 1), np.where(good, b_new / safe, 0)
        d_new = (v - r2 * d - epsilon * d_old) / safe
        t += np.where(good, c_new * rest, 0) * d_new
        rest = np.where(good, -s_new * rest, rest)
        d_old, d = d, d_new
        c_old, s_old, c, s = c, s, c_new, s_new
        alive = good & (np.abs(rest) > least * first) & (b_new > _EPS * first)
        v_old, v, b = v, u / np.where(b_new > 0, b_new, 1), b_new
    return t


def eigenpairs(product: Callable[[np.ndarray], np.ndarray], dimensions: int, wanted: int, seed: int = 42, widest: int = 6, inner: int = INNER) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``wanted`` largest eigenvalues, falling, their unit vectors, and the largest residual relative to the largest
    eigenvalue, of the symmetric positive semidefinite matrix behind ``product``.

    A pair is locked when its residual is at most 16 rounding units of the largest eigenvalue for each 8 dimensions' root,
    or has stopped falling under a thousand times that (rounding of the products allows no more)."""
    wanted = min(wanted, dimensions)
    locked, values = np.zeros((dimensions, 0)), np.zeros(0)
    space = _orthonormal(np.random.default_rng(seed).standard_normal((dimensions, min(dimensions, 2 * wanted))))
    image = product(space)
    least, worst = 16 * _EPS * max(1.0, math.sqrt(dimensions) / 8), 0.0
    last: list[float] = []
    while len(values) < wanted:
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        need = min(wanted - len(values), space.shape[1])
        u, shifts = space[:, :need], theta[:need]
        residual = image[:, :need] - u * shifts
        residual -= locked @ (locked.T @ residual)
        top = max([*values, theta[0], np.finfo(np.float64).tiny])
        sizes = np.linalg.norm(residual, axis=0) / top
        last.append(float(sizes.max()))
        stuck = len(last) > 3 and last[-1] > 0.5 * min(last[:-2]) and last[-1] <= 1000 * least
        done = 0
        while done < need and (sizes[done] <= least or stuck):
            done += 1
        if done:
            worst = max(worst, float(sizes[:done].max()))
            locked, values = np.column_stack([locked, u[:, :done]]), np.append(values, shifts[:done])
            space, image, u, shifts, residual = space[:, done:], image[:, done:], u[:, done:], shifts[done:], residual[:, done:]
            last = []
            if len(values) >= wanted or locked.shape[1] == dimensions:
                break
        if space.shape[1] + locked.shape[1] >= dimensions or space.shape[1] > widest * wanted:
            keep = min(space.shape[1], max(2 * wanted, u.shape[1] + 2))
            space = _orthonormal(space[:, :keep], locked)
            image = product(space)  # afresh: no rounding of earlier turns is kept
            if locked.shape[1] + keep >= dimensions:
                continue
        if not u.shape[1]:
            fresh = np.random.default_rng(seed + len(values)).standard_normal((dimensions, 2))
        else:
            held = np.column_stack([locked, u])

            def off(x: np.ndarray, held: np.ndarray = held) -> np.ndarray:
                x = x - held @ (held.T @ x)
                return x - held @ (held.T @ x)

            fresh = minres(product, shifts, off, -off(residual), inner, 0.05)
        fresh = _orthonormal(np.column_stack([fresh, residual]) if u.shape[1] else fresh, locked, space)
        fresh = fresh[:, :max(1, u.shape[1])]
        if not fresh.shape[1]:
            fresh = _orthonormal(np.random.default_rng(seed + len(last)).standard_normal((dimensions, 2)), locked, space)
        if not fresh.shape[1]:
            space = _orthonormal(space, locked)
            image = product(space)
            continue
        space, image = np.column_stack([space, fresh]), np.column_stack([image, product(fresh)])
    order = np.argsort(-values, kind="stable")
    return values[order], locked[:, order], worst


def whiten(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = 8) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row of ``vectors`` and
    component, ``components`` at most (as many as a vector has entries).

    Rows whose vector is null, or holds a null or non-finite entry, are left out. A vector shorter than the longest counts as
    filled up with entries of 0; entries over 4e12 count as that. A component without variance to speak of (all rows
    equal, more components than different rows) has whitened null and takes no part in identity_error, which is null if
    there is no other; explained is null if all rows are equal. ``deviation`` is a decimal of 38 digits. Equal rows and null
    ids stay; tables without usable rows or entries give an empty result; further columns are not read.
    """
    spark = vectors.sparkSession
    good = usable(vectors.select(id_column, column), column)
    longest = good.agg(F.max(F.size(column))).first()[0]
    kind = vectors.schema[id_column].dataType.simpleString()
    fields = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not longest:
        return spark.createDataFrame([], f"`{id_column}` {kind}, {fields}")
    dimensions = int(longest)
    moments = Moments(written(blocks(good, column, dimensions), "vector-blocks"), dimensions)
    trace = moments.trace()
    values, directions, _ = eigenpairs(moments.product, dimensions, components) if trace else (np.zeros(min(components, dimensions)), np.eye(dimensions)[:, :components], 0.0)
    some = values > max(dimensions, 16) * _EPS * trace
    scaled = directions[:, some] / np.sqrt(values[some])
    k = int(some.sum())
    error = None
    if k:
        mean = moments.summed(lambda z: (z @ scaled).sum(0)[:, None], k, 1)[:, 0] / moments.n

        def spread(z: np.ndarray) -> np.ndarray:
            w = z @ scaled - mean
            return w.T @ w

        error = float(np.abs(moments.summed(spread, k, k) / moments.n - np.eye(k)).max())
    explained = [float(v / trace) if trace else None for v in values]
    centre, deviation, n = moments.centre(), moments.deviation(), moments.n

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = len(values)
        rows = max(1, BLOCK_VALUES // max(dimensions, m))
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                x = integers(part.column(1), dimensions)
                w = np.full((len(x), m), np.nan)
                w[:, some] = centre(x) @ scaled
                every = pa.array(np.repeat(np.arange(len(x)), m))
                numbers = pa.array(deviation(x), pa.decimal128(38, 0))
                yield pa.record_batch([
                    part.column(0).take(every), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * m, n)),
                    numbers.take(every), pa.array(w.ravel(), from_pandas=True), pa.array(explained * len(x), pa.float64()),
                    pa.array([error] * (len(x) * m), pa.float64())], names=[id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return good.mapInArrow(project, f"`{id_column}` {kind}, {fields}")
