"""Whitening of embeddings by a block Jacobi-Davidson method on distributed products.

The covariance is never formed.  The vectors that take part are written once,
as integer matrices of some thousand rows; every step needs products ``V u`` for a few directions ``u``, and
one pass over the table gives them for all of a step's directions: a task
centres its rows, multiplies them by the directions and back, and a Spark
aggregate adds the tasks' sums.

1. Rayleigh-Ritz in a search space of a few directions gives approximate
   components; those whose residual reaches double precision are locked, in
   order, and taken out of the search.
2. For each of the others the correction equation, projected on the
   complement of the locked and current components, is solved by a few MINRES
   steps.  The solvers run side by side, so a step of all of them is one pass.
3. The corrections, made orthogonal, join the search space; a full one starts
   again from its best directions.

What reaches the driver: sums per dimension, and a matrix of dimensions by
directions for each pass.

Defined results
  null vector, null or non-finite component, or a component whose scaled
  value is beyond 2**31: takes no part; null id: takes part; repeated rows:
  each counts; vectors of different lengths: missing components count as
  zero; directions without variance (fewer than ``components`` remain, or
  none): not returned; equal eigenvalues: any orthonormal basis of their
  space; empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prioritext.llm.tables import table, written

SCALE, SHIFT, LARGEST = 1024, 100_000, 2.0**31
COMPONENTS = 8
# Residual, relative to the largest eigenvalue, at which a component is locked.
PRECISION = 2.0**-46
INNER_STEPS = 6
SEARCH_BLOCKS = 6
SUB_ROWS = 4_096
_SMALL = 2.0**-40


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, x)`` of the vectors that take part, components as ``floor(SCALE * c) + SHIFT``."""

    def scaled(c):
        return F.floor(c.cast("double") * SCALE)

    bad = F.exists(
        vec_col, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) >= F.lit(LARGEST / SCALE))
    )
    return vectors.filter(F.col(vec_col).isNotNull() & ~bad).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(vec_col, lambda c: scaled(c).cast("long") + SHIFT).alias("x"),
    )


def rows_of(column: pa.Array, dim: int) -> np.ndarray:
    """Integer rows of ``dim`` entries; missing ones are those of a zero component."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.full((len(sizes), dim), SHIFT, dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(begin, sizes)] = flat
    return out


def packed(x: DataFrame, dim: int) -> DataFrame:
    """``(ids, rows)``: matrices of at most ``SUB_ROWS`` vectors, 8 bytes an entry, and their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, SUB_ROWS):
                some = batch.slice(low, SUB_ROWS)
                ids = pa.ListArray.from_arrays(pa.array([0, some.num_rows], pa.int32()), some.column("vec_id"))
                rows = pa.array([rows_of(some.column("x"), dim).astype("<i8").tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, rows], names=["ids", "rows"])

    return x.select("vec_id", "x").mapInArrow(run, "ids array<long>, rows binary")


def matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for rows in batch.column("rows"):
            yield np.frombuffer(rows.as_buffer(), dtype="<i8").reshape(-1, dim)


class Fit:
    """Integer vectors, written as matrices, with their number, sums and covariance products."""

    def __init__(self, x: DataFrame):
        self.dim = x.agg(F.max(F.size("x"))).first()[0] or 0
        self.n, self.sums, self.passes = 0, [0] * self.dim, 0
        if not self.dim:
            return
        self.x = written(packed(x, self.dim), "whitening")
        self.n = self.x.agg(F.sum(F.size("ids"))).first()[0]
        dim = self.dim

        def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in matrices(batches, dim):  # an entry is below 2**32, so that a matrix's sum is a long
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(rows.sum(axis=0))], names=["i", "s"])

        sums = self.x.select("rows").mapInArrow(total, "i long, s long").groupBy("i")
        for row in sums.agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s")).collect():
            self.sums[row["i"]] = int(row["s"])
        # S / n in a whole and a fractional part, so that x - mean loses nothing
        self.whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        self.part = np.array([(s % self.n) / self.n for s in self.sums])

    def summed(self, per_rows, width: int) -> np.ndarray:
        """The sum over all rows of ``per_rows(centred rows)``, an array of ``width`` numbers."""
        dim, whole, part = self.dim, self.whole, self.part

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width)
            for rows in matrices(batches, dim):
                total += per_rows((rows - whole) - part).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["i", "y"])

        self.passes += 1
        sums = self.x.select("rows").mapInArrow(run, "i long, y double").groupBy("i").agg(F.sum("y").alias("y"))
        out = np.zeros(width)
        found = sums.toArrow()
        out[found.column("i").to_numpy()] = found.column("y").to_numpy()
        return out

    def product(self, directions: np.ndarray) -> np.ndarray:
        """``V u`` for each column ``u``: one pass over the table."""
        u = np.ascontiguousarray(directions)
        return self.summed(lambda c: c.T @ (c @ u), u.size).reshape(u.shape) / self.n

    def trace(self) -> float:
        return float(self.summed(lambda c: np.array([(c * c).sum()]), 1)[0]) / self.n


Steps = Generator[np.ndarray, np.ndarray, np.ndarray]


def minres(rhs: np.ndarray, shift: float, project, steps: int, goal: float) -> Steps:
    """MINRES for ``P (V - shift) P t = rhs``: yields the vectors to be multiplied by V, returns ``t``."""
    t, beta = np.zeros_like(rhs), float(np.linalg.norm(rhs))
    if beta == 0:
        return t
    before, q = np.zeros_like(rhs), rhs / beta
    d_old, d_older = np.zeros_like(rhs), np.zeros_like(rhs)
    left, cos, sin, cos_old, sin_old = beta, 1.0, 0.0, 1.0, 0.0
    start, off = beta, 0.0
    for _ in range(steps):
        image = yield q
        w = project(image - shift * q) - off * before
        alpha = float(q @ w)
        w -= alpha * q
        new_off = float(np.linalg.norm(w))
        # the rotations so far act on the new column (off, alpha, new_off)
        r3 = sin_old * off
        r2 = cos * cos_old * off + sin * alpha
        r1 = cos * alpha - sin * cos_old * off
        size = float(np.hypot(r1, new_off))
        if size == 0:
            break
        cos_old, sin_old, cos, sin = cos, sin, r1 / size, new_off / size
        d = (q - r2 * d_old - r3 * d_older) / size
        t += cos * left * d
        left *= -sin
        d_old, d_older = d, d_old
        if abs(left) <= goal * start or new_off <= 1e-300:
            break
        before, q, off = q, w / new_off, new_off
    return t


def side_by_side(solvers: list[Steps], product) -> list[np.ndarray]:
    """The results of solvers whose wanted products are made together, one pass a step."""
    results: list = [None] * len(solvers)
    waiting: dict[int, np.ndarray] = {}

    def advance(i: int, answer: np.ndarray | None) -> None:
        try:
            waiting[i] = solvers[i].send(answer)
        except StopIteration as end:
            waiting.pop(i, None)
            results[i] = end.value

    for i in range(len(solvers)):
        advance(i, None)
    while waiting:
        order = sorted(waiting)
        images = product(np.stack([waiting[i] for i in order], axis=1))
        for column, i in enumerate(order):
            advance(i, images[:, column])
    return results


def orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of ``new`` add to the given bases."""
    kept: list[np.ndarray] = []
    for v in new.T:
        size = np.linalg.norm(v)
        if not size:
            continue
        v = v / size
        for _ in range(3):
            for b in bases:
                v = v - b @ (b.T @ v)
            for k in kept:
                v = v - k * (k @ v)
            size = np.linalg.norm(v)
            if size < 1e-10:
                break
            v = v / size
        else:
            kept.append(v)
    return np.stack(kept, axis=1) if kept else np.zeros((new.shape[0], 0))


@dataclass
class Components:
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors, one a column
    residuals: np.ndarray  # relative to the largest eigenvalue
    passes: int


def jacobi_davidson(product, dim: int, wanted: int, precision: float = PRECISION, seed: int = 7) -> Components:
    """The ``wanted`` largest eigenpairs of the symmetric matrix behind ``product``."""
    wanted = min(wanted, dim)
    random, passes = np.random.default_rng(seed), 0

    def counted(u: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return product(u)

    locked, values, errors = np.zeros((dim, 0)), [], []
    search = orthonormal(random.standard_normal((dim, min(dim, wanted + 4))))
    image = counted(search)
    stalled, best = 0, np.inf
    while len(values) < wanted:
        small = search.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        ritz, ritz_image = search @ turn, image @ turn
        top = max([abs(theta[0]) if len(theta) else 0.0, *map(abs, values[:1])])
        left = wanted - len(values)
        residual = ritz_image[:, :left] - ritz[:, :left] * theta[:left]
        residual -= locked @ (locked.T @ residual)
        error = np.linalg.norm(residual, axis=0) / (top or 1.0)
        # a residual that no longer falls is as good as the products' rounding lets it be
        stalled, best = (stalled + 1, best) if error.max(initial=0.0) > best / 2 else (0, error.max(initial=0.0))
        full = ritz.shape[1] + locked.shape[1] >= dim
        reached = (error <= precision) | ((error <= 64 * precision) & (full or stalled > 2))
        reached |= full and stalled > 6
        done = int(np.argmin(reached)) if not reached.all() else len(reached)
        if done:
            locked = np.concatenate((locked, ritz[:, :done]), axis=1)
            values += theta[:done].tolist()
            errors += error[:done].tolist()
            stalled, best = 0, np.inf
            search, image = ritz[:, done:], ritz_image[:, done:]
            if len(values) >= wanted:
                break
            ritz, ritz_image, theta = search, image, theta[done:]
            residual, left = residual[:, done:], left - done
        width = min(ritz.shape[1], wanted + 4)
        if ritz.shape[1] + left > SEARCH_BLOCKS * (wanted + 4):
            search, image = ritz[:, :width], ritz_image[:, :width]
        else:
            search, image = ritz, ritz_image
        near = np.concatenate((locked, ritz[:, :left]), axis=1)

        def project(v: np.ndarray, near: np.ndarray = near) -> np.ndarray:
            return v - near @ (near.T @ v)

        solvers = [minres(project(-residual[:, i]), theta[i], project, INNER_STEPS, 0.02) for i in range(residual.shape[1])]
        corrections = side_by_side(solvers, counted)
        added = orthonormal(np.stack(corrections, axis=1), locked, search)
        if not added.shape[1]:  # the search is stuck in an invariant space: look elsewhere
            added = orthonormal(random.standard_normal((dim, max(1, left))), locked, search)
        if added.shape[1]:
            search = np.concatenate((search, added), axis=1)
            image = np.concatenate((image, counted(added)), axis=1)
    order = np.argsort(-np.array(values), kind="stable")
    return Components(np.array(values)[order], locked[:, order], np.array(errors)[order], passes)


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` of every vector that takes part.

    ``deviation`` is null where the exact number is beyond a long.
    """
    spark = vectors.sparkSession
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    fit = Fit(quantised(vectors, id_col, vec_col))
    trace = fit.trace() if fit.dim else 0.0
    if not trace:
        return spark.createDataFrame([], schema)
    found = jacobi_davidson(fit.product, fit.dim, components)
    keep = found.values > _SMALL * trace
    values, k = found.values[keep], int(keep.sum())
    weights = found.vectors[:, keep] / np.sqrt(values)
    mean = fit.summed(lambda c: (c @ weights).sum(axis=0), k) / fit.n

    def spread(c: np.ndarray) -> np.ndarray:
        y = c @ weights - mean
        return y.T @ y

    identity_error = float(np.abs(fit.summed(spread, k * k).reshape(k, k) / fit.n - np.eye(k)).max())
    n, dim, whole, part, sums = fit.n, fit.dim, fit.whole, fit.part, fit.sums
    explained = values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, rows in zip(batch.column("ids"), matrices([batch], dim), strict=True):
                whitened = ((rows - whole) - part) @ weights
                size = len(rows)
                each = pa.array(np.repeat(np.arange(size), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                        pa.array(np.full(size * k, n)),
                        deviations(rows, n, sums).take(each),
                        pa.array(whitened.ravel()),
                        pa.array(np.tile(explained, size)),
                        pa.array(np.full(size * k, identity_error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return fit.x.mapInArrow(run, schema)


def deviations(rows: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """``sum((n * x - S) ** 2)`` of each row, exact; null beyond a long."""
    reach = max((max(abs(n * int(a) - s), abs(n * int(b) - s)) for a, b, s in zip(rows.min(axis=0), rows.max(axis=0), sums, strict=True)), default=0)
    if reach * reach * max(1, rows.shape[1]) < 1 << 63:
        away = rows * n - np.array(sums, dtype=np.int64)
        return pa.array((away * away).sum(axis=1))
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in rows]
    return pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())


def op11_jacobi_davidson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened first eight components of every embedding."""
    return whiten(table(spark, sf_dir, "embeddings"))
