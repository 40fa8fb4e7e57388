"""Operator 12: whitening of embeddings by eigenvectors that are refined from single to double precision.

A vector's entries become integers, floor(256 * entry). The fit list holds each distinct vector once. Its size n and sums S are
exact, and so is the covariance before it is divided: each task centres its vectors on the rounded means, multiplies them in
blocks, whose sums of products are exact in doubles, and Spark adds the blocks of each pair of dimensions as decimals.
What is left of the means (less than a half in each dimension) is taken off afterwards, in rational arithmetic.

The d x d matrix is solved on the driver, its size does not depend on the rows: single-precision eigenvectors are corrected by the
iterations of Ogita and Aishima, four products of matrices each, in extended precision (``PRECISE``). With X the
current vectors, R = I - X'X and S = X'AX, entry ij of the correction is (s_ij + l_j r_ij) / (l_j - l_i), and r_ij / 2 where
two eigenvalues are closer than the residuals can tell apart. Such clusters are then parted by sub-solves: the matrix, less the
cluster's mean value, projected on the cluster's vectors, is small in norm, so a double-precision solve of it resolves gaps that
were below the first solve's precision; its rotation goes into X and iterations go on.

Each row's vector is projected in its own task, with n, S, vectors and values in the closure; nothing is joined. The check of
identity is a pass over the fit list, grouped again into one row a task.

Vectors that are null or hold null or non-finite entries take no part, nor do those with an entry of 2**32 or more in absolute value
(their squares don't add up exactly). A shorter vector counts as filled with zeros. Repeated rows, and rows with a null vec_id, each get
their result. Components whose eigenvalue is zero to double precision (fewer distinct vectors than dimensions, constant dimensions) have
null ``whitened``, and ``explained`` is null if the trace is zero; ``identity_error`` is over the other components, null if there is
none. ``deviation`` is null where it exceeds a long. An empty table, or vectors without entries only, give no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

COMPONENTS = 4
SCALE, LARGEST = 256, float(1 << 32)
#: Rows of a block; 2**10 products of 2**21 each stay exact in a double.
ROWS, EXACT_ENTRY = 1 << 10, 1 << 21
PRECISE = np.longdouble
_VALUES = "i int, j int, value decimal(38,0)"


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): the vectors that take part, as longs."""
    entries = F.transform("embedding", lambda e: e.cast("double"))
    good = F.col("embedding").isNotNull() & F.forall(entries, lambda e: F.coalesce(F.abs(e) < LARGEST, F.lit(False)))
    return vectors.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(entries, lambda e: F.floor(SCALE * e).cast("long")).alias("x"))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of int64, filled with zeros up to ``width``; from an array of lists of longs."""
    ends = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy()[ends[0] : ends[-1]]
    ends -= ends[0]
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - ends[:-1][row]] = flat
    return out


def exact_products(y: np.ndarray) -> list[list[int]]:
    """Sums over rows of products of each two columns, as exact integers."""
    parts = []  # y as a sum of digits small enough that blocks of products are exact in doubles
    while True:
        low = ((y + EXACT_ENTRY // 2) & (EXACT_ENTRY - 1)) - EXACT_ENTRY // 2
        parts.append(low.astype(float))
        y = (y - low) // EXACT_ENTRY
        if not y.any():
            break
    total = np.zeros((parts[0].shape[1],) * 2, object)
    for p, a in enumerate(parts):
        for q, b in enumerate(parts):
            total = total + (a.T @ b).astype(np.int64).astype(object) * EXACT_ENTRY ** (p + q)
    return total.tolist()


def fitted(fit: DataFrame) -> tuple[int, list[int], list[list[Fraction]]]:
    """n, S and the covariance of the fit list ``x``, all exact."""
    n, width = fit.agg(F.count("*"), F.max(F.size("x"))).first()
    if not n or not width:
        return n, [], []
    sums = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s"))
    held = {r.i: int(r.s) for r in sums.collect()}  # a row a dimension
    total = [held.get(i, 0) for i in range(width)]
    centre = [round(Fraction(s, n)) for s in total]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, c = 0, np.array(centre, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                found = found + np.array(exact_products(matrix(batch.column("x").slice(at, ROWS), width) - c), object)
        if not isinstance(found, int):
            i, j = np.triu_indices(width)
            value = pa.array([Decimal(v) for v in found[i, j]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), value], ["i", "j", "value"])

    rows = fit.select("x").mapInArrow(products, _VALUES).groupBy("i", "j").agg(F.sum("value").alias("value")).collect()  # d (d + 1) / 2 rows
    left = [Fraction(s, n) - c for s, c in zip(total, centre)]
    cov = [[Fraction(0)] * width for _ in range(width)]
    for i, j, value in rows:
        cov[i][j] = cov[j][i] = Fraction(int(value), n) - left[i] * left[j]
    return n, total, cov


def precise(cov: list[list[Fraction]]) -> np.ndarray:
    """The matrix in extended precision: a double and what it leaves."""
    high = [[float(v) for v in row] for row in cov]
    low = [[float(v - Fraction(h)) for v, h in zip(*rows)] for rows in zip(cov, high)]
    return np.array(high).astype(PRECISE) + np.array(low).astype(PRECISE)


def clusters(values: np.ndarray, least: float) -> list[np.ndarray]:
    """Places of the values in groups, by falling value, in which each is within ``least`` of the next one."""
    order = np.argsort(-values, kind="stable")
    return np.split(order, np.flatnonzero(-np.diff(values[order]) > least) + 1)


def corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One iteration: (better vectors, values, the gap up to which values count as one)."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    s = (s + s.T) / 2  # else rounding, divided by small gaps, would spoil the vectors' right angles
    values = np.diag(s) / (1 - np.diag(r))
    off = (s - np.diag(values)).astype(float)
    least = 2 * (np.linalg.norm(off, 2) + np.linalg.norm(a.astype(float), 2) * np.linalg.norm(r.astype(float), 2))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > least
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ e, values, float(least)


def parted(a: np.ndarray, x: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The group's vectors turned within their space to those of the matrix less the group's mean value."""
    own = x[:, group]
    mean = np.mean(np.sum(own * (a @ own), axis=0))
    small = own.T @ (a @ own - mean * own)
    small = (small + small.T) / 2
    size = np.abs(small).max()
    if not size:
        return own
    turn = np.linalg.eigh((small / size).astype(float))[1].astype(a.dtype)
    return own @ (turn @ (3 * np.eye(len(turn), dtype=a.dtype) - turn.T @ turn) / 2)  # right angles beyond double precision


def eigen(a: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors in columns) of a symmetric matrix in extended precision, by falling value."""
    scale = np.abs(a).max() or PRECISE(1)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(a.dtype)
    floor = 4 * len(a) * float(np.finfo(a.dtype).eps)
    for _ in range(rounds):
        better, values, least = corrected(a, x)
        if least <= floor:
            break
        x = better
        for g in clusters(values, least):
            if len(g) > 1:
                x[:, g] = parted(a, x, g)
    values = np.sum(x * (a @ x), axis=0) / np.sum(x * x, axis=0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt(np.sum(x[:, order] ** 2, axis=0))
    x = x * np.where(x[np.argmax(np.abs(x), axis=0), np.arange(len(a))] < 0, -1, 1)  # one sign for all rows and runs
    return values[order] * scale, x


class Whitening:
    """What a task needs to whiten a vector; its size depends on the dimensions only."""

    def __init__(self, n: int, total: list[int], cov: list[list[Fraction]], components: int = COMPONENTS):
        values, vectors = eigen(precise(cov))
        self.n, self.total, self.width = n, total, len(total)
        self.components = min(components, self.width)
        trace = sum(cov[i][i] for i in range(self.width))
        self.explained = [float(v) / float(trace) if trace else None for v in values[: self.components]]
        zero = self.width * np.finfo(float).eps * max(float(values[0]), 0.0)
        self.full = [float(v) > zero for v in values[: self.components]]
        root = np.sqrt(np.where(self.full, np.maximum(values[: self.components], 0), 1))
        self.project = vectors[:, : self.components] / root
        self.centre = np.array([round(Fraction(s, n)) for s in total], np.int64)
        left = [Fraction(s, n) - int(c) for s, c in zip(total, self.centre)]
        self.shift = np.array([float(v) for v in left]).astype(PRECISE) @ self.project

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows of components; the product is in extended precision, so that far vectors lose nothing."""
        return ((x - self.centre).astype(PRECISE) @ self.project - self.shift).astype(float)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sums of (n x - S) ** 2; None beyond a long."""
        limit = max(int(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.total))) * 2
        kind = np.int64 if limit * limit * self.width < 1 << 63 else object
        d = x.astype(kind) * self.n - np.array(self.total, kind)
        return [v if v < 1 << 63 else None for v in (d * d).sum(axis=1).tolist()]


def identity_error(fit: DataFrame, w: Whitening) -> float | None:
    """The largest difference of the whitened fit list's covariance from the identity."""
    held = [i for i in range(w.components) if w.full[i]]
    if not held:
        return None
    k = len(held)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            y = w.whitened(matrix(batch.column("x"), w.width))[:, held]
            first, second = first + y.sum(axis=0), second + y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([[*first, *second.ravel()]])], ["v"])

    sums = fit.select("x").mapInArrow(products, "v array<double>").select([F.sum(F.col("v")[i]) for i in range(k + k * k)]).first()
    mean, second = np.array(sums[:k]) / w.n, np.array(sums[k:]).reshape(k, k) / w.n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each vector and component."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = integers(vectors)
    fit = written(rows.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit")
    n, total, cov = fitted(fit)
    if not total:
        return vectors.sparkSession.createDataFrame([], schema)
    w = Whitening(n, total, cov, components)
    error = identity_error(fit, w)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = w.components
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = matrix(part.column("x"), w.width)
                m = len(x)
                y, place = w.whitened(x), pa.array(np.repeat(np.arange(m), k))
                columns = [part.column("vec_id").take(place), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array([n] * (m * k), pa.int64())]
                columns += [pa.array(w.deviations(x), pa.int64()).take(place), pa.array(y.ravel(), mask=np.tile(~np.array(w.full), m))]
                columns += [pa.array(w.explained * m, pa.float64()), pa.array([error] * (m * k), pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    return rows.mapInArrow(apply, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
