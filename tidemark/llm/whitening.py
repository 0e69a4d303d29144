"""Embedding whitening: principal components of integer vectors by spectral divide and conquer, then projection of every row.

Spark makes the list of distinct vectors, their sums and their covariance. The covariance, whose size is that of one vector
squared, is split on the driver: the polar factor of the shifted matrix (QDWH) is its sign, which gives the projectors on the
eigenvectors above and below the shift; both parts are split again until single components are left.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

EPS = np.finfo(np.float64).eps
#: A vector entry c becomes floor(GRID * c).
GRID = 256


def integers(rows: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, x): floor(256 c) of each entry c as a long, for rows whose vector has entries and none of them null or not finite.

    Entries beyond a long become the nearest one. Null and repeated vec_ids stay. Other columns are not read.
    """
    sound = lambda e: e.isNotNull() & (F.abs(e) < F.lit(float("inf")))  # noqa: E731  (NaN is greater than all)
    grid = lambda e: F.floor(e.cast("double") * GRID).cast("long")
    v = F.col(f"`{vector}`")
    return rows.filter(v.isNotNull() & (F.size(v) > 0) & F.forall(v, sound)).select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.transform(v, grid).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as a matrix."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def _halves(batches):
    """A mapInArrow function over (x): how many there are, and sums of the upper and the lower 32 bits by dimension, which no task overflows."""
    n, high, low = 0, 0, 0
    for batch in batches:
        x = _matrix(batch.column(0))
        if len(x):
            n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
    if n:
        yield pa.record_batch({"i": pa.array(range(len(high)), pa.int32()), "n": pa.array([n] * len(high), pa.int64()), "high": pa.array(high), "low": pa.array(low)})


def _products(mean: np.ndarray, onto: np.ndarray | None = None):
    """A mapInArrow function over (x): rows of the sum of products of the centred vectors, or of their projections."""

    def products(batches):
        total = 0
        for batch in batches:
            if batch.num_rows:
                z = _matrix(batch.column(0)) - mean
                z = z if onto is None else z @ onto
                total = total + z.T @ z
        if isinstance(total, np.ndarray):
            yield pa.record_batch({"i": pa.array(range(len(total)), pa.int32()), "row": pa.array(list(total), pa.list_(pa.float64()))})

    return products


def _summed(key, table):
    return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "row": pa.array([_matrix(table.column("row").combine_chunks()).sum(0)], pa.list_(pa.float64()))})


def _covariance(fit: DataFrame, n: int, mean: np.ndarray, onto: np.ndarray | None = None) -> np.ndarray:
    """As large as a vector squared: tasks add up their own vectors, then each row of the matrix is added up over the tasks."""
    rows = fit.mapInArrow(_products(mean, onto), "i int, row array<double>").groupBy("i").applyInArrow(_summed, "i int, row array<double>").collect()
    v = np.array([r["row"] for r in sorted(rows, key=lambda r: r["i"])]) / n
    return (v + v.T) / 2


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix by dynamically weighted Halley steps; for a matrix without eigenvalue 0, its sign.

    The steps with large weights take a QR factorization, which keeps them stable whatever the condition, the last ones a Cholesky one.
    """
    m, unit = len(a), np.eye(len(a))
    x, low = a / np.linalg.norm(a), EPS / 2
    for _ in range(30):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square / square)
        root = np.sqrt(1 + d)
        p = root + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root)) / 2
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        before = x
        if r > 100:
            both, _ = np.linalg.qr(np.vstack([np.sqrt(r) * x, unit]))
            x = q / r * x + (p - q / r) / np.sqrt(r) * (both[:m] @ both[m:].T)
        else:
            lower = np.linalg.cholesky(unit + r * (x.T @ x))
            x = q / r * x + (p - q / r) * np.linalg.solve(lower.T, np.linalg.solve(lower, x.T)).T
        low = min(1.0, low * (p + q * square) / (1 + r * square))
        if 1 - low < 10 * EPS and np.linalg.norm(x - before) < np.cbrt(EPS):
            break
    return (x + x.T) / 2


def _shifts(a: np.ndarray):
    """Where to split: at the middle of the diagonal, at the mean of the eigenvalues, else near it, never outside them."""
    mean, wide = np.trace(a) / len(a), np.linalg.norm(a - np.eye(len(a)) * np.trace(a) / len(a)) / np.sqrt(len(a))
    yield float(np.median(np.diag(a)))
    yield from (mean + wide * t for t in (0.0, 0.13, -0.13, 0.37, -0.37, 0.71, -0.71))


def _split(a: np.ndarray, scale: float, draws: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenvectors above and below a shift; None if all eigenvalues are equal to working precision."""
    m, unit, best = len(a), np.eye(len(a)), None
    if np.linalg.norm(a - unit * np.trace(a) / m) <= m * EPS * scale:
        return None
    for shift in _shifts(a):
        moved = a - shift * unit
        if np.linalg.norm(moved) <= EPS * scale:
            continue
        above = (polar_factor(moved) + unit) / 2
        k = int(round(np.trace(above)))
        if not 0 < k < m:
            continue
        basis = [p @ draws.standard_normal((m, j)) for p, j in ((above, k), (unit - above, m - k))]
        basis = [p @ np.linalg.qr(y)[0] for p, y in zip((above, unit - above), basis, strict=True)]
        q, _ = np.linalg.qr(np.hstack(basis))
        left = np.linalg.norm(q[:, k:].T @ a @ q[:, :k])  # what the two subspaces still have in common
        if best is None or left < best[0]:
            best = left, q[:, :k], q[:, k:]
        if left <= 4 * m * EPS * scale:
            break
    return None if best is None else best[1:]


def eigenvectors(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and its unit eigenvectors as columns; the largest entry of each is positive."""
    scale, draws, done = np.linalg.norm(v), np.random.default_rng(7), []
    parts = [np.eye(len(v))]
    while parts:
        q = parts.pop()
        halves = _split(q.T @ v @ q, scale, draws) if q.shape[1] > 1 and scale > 0 else None
        if halves is None:
            done.append(q)
        else:
            parts += [q @ h for h in halves]
    q = np.hstack(done)
    q = q @ (3 * np.eye(len(v)) - q.T @ q) / 2  # what rounding took of orthogonality
    e = np.einsum("ij,ij->j", q, v @ q)
    order = np.argsort(-e, kind="stable")
    e, q = e[order], q[:, order]
    return e, q * np.where(q[np.abs(q).argmax(0), np.arange(len(v))] < 0, -1, 1)


@dataclass(frozen=True)
class Whitening:
    """What a fit gives; ``components`` has an eigenvector in each column, without those of eigenvalue zero."""

    n: int
    sums: list[int]
    mean: np.ndarray
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    def weights(self, most: int | None = None) -> np.ndarray:
        return self.components[:, :most] / np.sqrt(self.eigenvalues[:most])


def fit_list(vectors: DataFrame, scratch: Scratch) -> DataFrame:
    """Each distinct vector once, of the length that most of them have (of equally many the longest)."""
    every = scratch.table(vectors.select("x").distinct(), "distinct")
    size = every.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return every.filter(F.size("x") == F.lit(size["d"] if size else 0))


def fit(distinct: DataFrame) -> Whitening | None:
    """Components of a list of distinct vectors of one length; None for an empty list."""
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    sums = distinct.mapInArrow(_halves, "i int, n long, high long, low long").groupBy("i").agg(F.sum("n").alias("n"), exact("high"), exact("low")).collect()
    if not sums:
        return None
    n, s = sums[0]["n"], [(int(r["high"]) << 32) + int(r["low"]) for r in sorted(sums, key=lambda r: r["i"])]
    mean = np.array([x / n for x in s])
    v = _covariance(distinct, n, mean)
    e, q = eigenvectors(v)
    real = e > len(e) * EPS * e[0]
    return Whitening(n, s, mean, e[real], q[:, real], float(np.trace(v)))


def identity_error(distinct: DataFrame, model: Whitening, most: int | None = None) -> float:
    """The largest absolute entry of the whitened list's covariance minus the identity."""
    w = model.weights(most)
    return float(np.abs(_covariance(distinct, model.n, model.mean, w) - np.eye(w.shape[1])).max()) if w.size else 0.0


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums of squares of n * x - S, exact; None beyond a long."""
    far = n * np.abs(x).max(initial=0).astype(float) + max(map(abs, sums))
    if far * far * x.shape[1] < 2.0**62:
        y = n * x - np.array(sums, np.int64)
        return (y * y).sum(1).tolist()
    exact = (sum((n * a - b) ** 2 for a, b in zip(row, sums, strict=True)) for row in x.tolist())
    return [y if y < 2**63 else None for y in exact]


def whiten(vectors: DataFrame, model: Whitening, most: int | None = None) -> DataFrame:
    """(vec_id, deviation, whitened) of each row with a vector of the fit's length: its exact distance from the mean, and its whitened components."""
    weights, mean, n, sums = model.weights(most), model.mean, model.n, model.sums

    def project(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1))
                yield pa.record_batch({"vec_id": batch.column(0), "deviation": pa.array(_deviations(x, n, sums), pa.int64()), "whitened": pa.array(list((x - mean) @ weights), pa.list_(pa.float64()))})

    return vectors.filter(F.size("x") == len(sums)).mapInArrow(project, "vec_id long, deviation long, whitened array<double>")


def report(rows: DataFrame, most: int = 4, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Per row with a whole vector and per component up to ``most``: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty, or holds null or non-finite entries go, and so do those of another length than most distinct vectors have.
    Repeated rows come back as often as they came and count once in the fit. Components whose eigenvalue is zero to working precision are
    left out, so there are no rows without two different vectors. ``deviation`` is null where it passes a long.
    """
    spark = rows.sparkSession
    vectors = integers(rows, vector, key)
    distinct = fit_list(vectors, Scratch(spark))
    model = fit(distinct)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not model.eigenvalues.size:
        return spark.createDataFrame([], schema)
    lit = lambda x, kind: F.lit(x).cast(kind)
    explained: Column = F.array(*(F.lit(float(e / model.trace)) for e in model.eigenvalues[:most]))
    each = whiten(vectors, model, most).select("vec_id", "deviation", F.posexplode(F.arrays_zip("whitened", explained.alias("explained"))).alias("i", "c"))
    return each.select(
        "vec_id", (F.col("i") + 1).cast("int").alias("component"), lit(model.n, "long").alias("n"), "deviation", "c.whitened", F.col("c.explained").alias("explained"), lit(identity_error(distinct, model, most), "double").alias("identity_error")
    )
