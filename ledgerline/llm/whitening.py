"""Embedding whitening: leading principal components of all vectors, and every vector projected on them.

Each entry c becomes the integer x = floor(1024 * c) + 100000.  The fit reads
all vectors once: a task keeps the count, the exact sums and the centred
products (d x d) of its rows, merging batch by batch around the mean of what it
has seen, so nothing is ever multiplied uncentred.  Spark adds the tasks'
matrices up by cell, each with the outer product of its mean's distance from
the mean of all; the d x d covariance is all that reaches the driver.

There it is brought to tridiagonal form by Householder reflections; bisection
with Sturm counts finds the leading eigenvalues, inverse iteration their
vectors, orthogonalised anew in every step within a cluster of close
eigenvalues, and the reflections take them back.  Mean and components
(d x 8 numbers) travel with the projecting function.

Defined results: vectors that are null, hold null or non-finite entries, or an
entry whose x a double can't hold exactly (1024 * c beyond 2**53) are dropped,
and so are vectors of another length than the most frequent one (ties: the
longest); null vec_id: kept; repeated rows: counted and projected each; an
empty table, or one whose vectors are all equal: no components, no rows.
Components whose eigenvalue can't be told from 0 (d * 2**-52 of the largest)
are left out.  ``deviation`` is null where it doesn't fit a long;
``deviation_wide`` (38 digits) has it then.  Other columns of the input are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import ready, stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
EPS = 2.0**-52
#: Eigenvalues closer than this share of the matrix's norm have their vectors orthogonalised against each other.
CLUSTER = 1e-3

_MOMENTS = "i int, n long, total decimal(38,0), mean array<double>, products array<double>"


# ---- eigenvectors of a symmetric matrix ----------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, Householder vectors) of a symmetric matrix; vector k acts on the places after k."""
    a = matrix.astype(float).copy()
    n = len(a)
    vectors = []
    for k in range(n - 2):
        x = a[k + 1 :, k]
        v = x.copy()
        size = np.linalg.norm(x)
        if size > 0:
            head = -size if x[0] >= 0 else size
            v[0] -= head
            v /= np.linalg.norm(v)
            rest = a[k + 1 :, k + 1 :]
            p = rest @ v
            w = 2 * (p - (v @ p) * v)
            rest -= np.outer(v, w) + np.outer(w, v)
            a[k + 1 :, k] = a[k, k + 1 :] = 0
            a[k + 1, k] = a[k, k + 1] = head
        vectors.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), vectors


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each value of ``at`` how many eigenvalues of the tridiagonal matrix are below it."""
    tiny = np.finfo(float).tiny * max(1.0, float((off**2).max(initial=0.0)))
    q = diagonal[0] - at
    count = (q < 0).astype(int)
    for a, b in zip(diagonal[1:], off**2, strict=True):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = a - at - b / q
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection until neighbouring doubles (or the norm's last bits) are left."""
    n = len(diagonal)
    around = np.concatenate(([0.0], np.abs(off))) + np.concatenate((np.abs(off), [0.0]))
    norm = float((np.abs(diagonal) + around).max())
    lo, hi = np.full(k, -norm), np.full(k, norm)
    lo -= EPS * norm
    hi += EPS * norm
    rank = n - np.arange(k)  # this many eigenvalues are at most the wanted one
    for _ in range(200):
        mid = (lo + hi) / 2
        up = sturm_counts(diagonal, off, mid) < rank
        lo, hi = np.where(up, mid, lo), np.where(up, hi, mid)
        if np.all(hi - lo <= EPS * np.maximum(np.abs(lo), EPS * norm)):
            break
    return (lo + hi) / 2


def _solved(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """Solution of (T - shift) y = right by elimination with row exchanges; pivots below ``least`` count as it."""
    n = len(diagonal)
    d, u, u2, y = diagonal - shift, np.append(off, 0.0), np.zeros(n), right.copy()
    low = off.copy()
    for i in range(n - 1):
        if abs(low[i]) > abs(d[i]):
            # The row below has the larger pivot: exchange the two.
            d[i], low[i] = low[i], d[i]
            u[i], d[i + 1] = d[i + 1], u[i]
            u2[i], u[i + 1] = u[i + 1], 0.0
            y[i], y[i + 1] = y[i + 1], y[i]
        if abs(d[i]) < least:
            d[i] = least
        f = low[i] / d[i]
        d[i + 1] -= f * u[i]
        u[i + 1] -= f * u2[i]
        y[i + 1] -= f * y[i]
    if abs(d[-1]) < least:
        d[-1] = least
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            y[i] -= u[i] * y[i + 1]
        if i + 2 < n:
            y[i] -= u2[i] * y[i + 2]
        y[i] /= d[i]
    return y


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) of falling ``values`` by inverse iteration, orthogonal within clusters."""
    n = len(diagonal)
    norm = float(np.abs(diagonal).max(initial=0.0) + 2 * np.abs(off).max(initial=0.0)) or 1.0
    rng = np.random.default_rng(13)
    found, first = [], 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        # Equal eigenvalues are parted by some last bits, so that each has a solve of its own.
        shift = value - (k - first) * 4 * EPS * norm
        y = rng.uniform(0.5, 1.0, n) * np.where(rng.random(n) < 0.5, -1, 1)
        for _ in range(6):
            y /= np.linalg.norm(y)
            y = _solved(diagonal, off, shift, y, EPS * norm)
            y /= np.abs(y).max()
            for _ in range(2):
                for other in found[first:k]:
                    y -= (other @ y) / (other @ other) * other
        found.append(y / np.linalg.norm(y))
    return np.array(found).reshape(len(values), n)


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(the ``k`` largest eigenvalues, falling; their unit eigenvectors as rows) of a symmetric matrix."""
    n = len(matrix)
    k = min(k, n)
    if k == 0:
        return np.zeros(0), np.zeros((0, n))
    size = float(np.abs(matrix).max()) or 1.0
    diagonal, off, reflections = tridiagonal(matrix / size)
    values = leading_eigenvalues(diagonal, off, k)
    vectors = tridiagonal_vectors(diagonal, off, values)
    for at in range(len(reflections) - 1, -1, -1):
        v = reflections[at]
        vectors[:, at + 1 :] -= 2 * np.outer(vectors[:, at + 1 :] @ v, v)
    return values * size, vectors


# ---- moments of all vectors ------------------------------------------------------------------


def whole_entries(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that remain, their floor(1024 * c) as an integer matrix) of a list<double> column."""
    offsets = column.offsets.to_numpy()
    rows = np.flatnonzero(np.asarray(column.is_valid()) & (np.diff(offsets) == dims))
    values = column.values.to_numpy(zero_copy_only=False).astype(float)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(SCALE * values[offsets[rows][:, None] + np.arange(dims)])
        good = (np.abs(scaled) <= 2.0**53).all(axis=1)
    return rows[good], scaled[good].astype(np.int64)


def exact_sums(x: np.ndarray) -> list[int]:
    low = x & ((1 << 26) - 1)
    return [(int(a) << 26) + int(b) for a, b in zip((x >> 26).sum(axis=0), low.sum(axis=0), strict=True)]


class Moments:
    """Count, exact sums (of integers), mean and centred products of rows seen so far."""

    def __init__(self, dims: int):
        self.n, self.total, self.mean, self.products = 0, [0] * dims, np.zeros(dims), np.zeros((dims, dims))

    def add(self, x: np.ndarray) -> None:
        k = len(x)
        if not k:
            return
        if x.dtype.kind == "i":
            sums = exact_sums(x)
            mean = np.array([s / k for s in sums])
            self.total = [a + b for a, b in zip(self.total, sums, strict=True)]
        else:
            mean = x.mean(axis=0)
        centred = x - mean
        step = mean - self.mean
        n = self.n + k
        self.products += centred.T @ centred + np.outer(step, step) * (self.n * k / n)
        self.mean = np.array([t / n for t in self.total]) if x.dtype.kind == "i" else self.mean + step * (k / n)
        self.n = n

    def rows(self) -> Iterator[pa.RecordBatch]:
        """One row per dimension, some megabytes at a time."""
        dims = len(self.mean)
        step = max(1, (1 << 18) // max(dims, 1))
        for lo in range(0, dims if self.n else 0, step):
            i = np.arange(lo, min(dims, lo + step))
            ends = pa.array(np.arange(len(i) + 1) * dims, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(i, pa.int32()),
                    pa.array(np.full(len(i), self.n)),
                    pa.array([self.total[j] for j in i], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(ends, np.tile(self.mean, len(i))),
                    pa.ListArray.from_arrays(ends, self.products[i].ravel()),
                ],
                ["i", "n", "total", "mean", "products"],
            )


def merged(parts: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """(count, exact sums, centred products) of all tasks' moments: d and d x d numbers come to the driver."""
    parts = stored(parts, "moments")
    sums = {
        r.i: r
        for r in parts.groupBy("i").agg(
            F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum(F.col("mean")[F.col("i")] * F.col("n")).alias("mass")
        ).collect()
    }
    if not sums:
        return 0, [0] * dims, np.zeros((dims, dims))
    n, total = sums[0].n, [int(sums[i].total) for i in range(dims)]
    # Integers have exact sums; of doubles the mean is what the tasks' means give.
    mean = [t / n for t in total] if any(total) else [sums[i].mass / n for i in range(dims)]
    means = F.array(*(F.lit(float(m)) for m in mean))
    away = F.zip_with("mean", means, lambda a, b: a - b)
    spread = parts.withColumn("away", away).select(
        "i", F.posexplode(F.zip_with("products", "away", lambda p, d: p + F.col("n") * F.element_at("away", F.col("i") + 1) * d))
        .alias("j", "v"),
    )
    out = np.zeros((dims, dims))
    for r in spread.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = r.v
    return n, total, (out + out.T) / 2


@dataclass
class Whitening:
    """Fitted on all vectors: ``sums`` are those of floor(1024 * c); components are rows."""

    dims: int
    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    def x_sums(self) -> list[int]:
        return [s + self.n * SHIFT for s in self.sums]

    def centred(self, y: np.ndarray) -> np.ndarray:
        """n * x - S as exact integers: long where they fit, else Python's."""
        if self.n * max(int(np.abs(y).max(initial=0)), *map(lambda s: abs(s) // self.n + 1, self.sums)) < 1 << 61:
            return y * self.n - np.array(self.sums, np.int64)
        return y.astype(object) * self.n - np.array(self.sums, object)

    def project(self, y: np.ndarray) -> np.ndarray:
        return (self.centred(y) / self.n).astype(float) @ (self.components / np.sqrt(self.eigenvalues)[:, None]).T

    def deviations(self, y: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n * x - S) ** 2, exact."""
        c = self.centred(y)
        if c.dtype == object:
            return [int(v) for v in (c * c).sum(axis=1)]
        if int(np.abs(c).max(initial=0)) ** 2 * max(self.dims, 1) < 1 << 63:
            return (c * c).sum(axis=1).tolist()
        high, low = c >> 31, c & ((1 << 31) - 1)
        # Three sums of products that fit a long each, put together as Python integers.
        parts = ((high.astype(object) ** 2).sum(axis=1), (high * low >> 31, high * low & (1 << 31) - 1), low * low)
        cross = [(int(a) << 31) + int(b) for a, b in zip(parts[1][0].sum(axis=1), parts[1][1].sum(axis=1), strict=True)]
        squares = [(int(a) << 31) + int(b) for a, b in zip((parts[2] >> 31).sum(axis=1), (parts[2] & (1 << 31) - 1).sum(axis=1), strict=True)]
        return [(int(h) << 62) + (x << 32) + s for h, x, s in zip(parts[0], cross, squares, strict=True)]


def _vectors(frame: DataFrame, column: str) -> DataFrame:
    return frame.select(F.col(column).cast("array<double>").alias("v"))


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Mean and leading components of all vectors of ``column``."""
    ready(vectors.sparkSession)
    rows = _vectors(vectors, column)
    longest = (
        rows.where("v is not null").groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.desc("dims")).first()
    )
    dims = longest.dims if longest else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Moments(dims)
        for batch in batches:
            seen.add(whole_entries(batch.column(0), dims)[1])
        yield from seen.rows()

    n, sums, products = merged(rows.mapInArrow(run, _MOMENTS), dims)
    cov = products / max(n, 1)
    values, found = leading_components(cov, components)
    keep = values > max(dims, 1) * EPS * max(values.max(initial=0.0), 0.0)
    return Whitening(dims, n, sums, values[keep], found[keep], float(np.trace(cov)))


def whiten(vectors: DataFrame, model: Whitening, column: str = "embedding", whitened: str = "whitened") -> DataFrame:
    """The rows whose vectors remain, with their projection (array of doubles, falling eigenvalues) as ``whitened``.

    All other columns go along; one named like the new column is replaced.
    """
    spark = ready(vectors.sparkSession)
    rest = [c for c in vectors.columns if c not in (whitened,)]
    frame = vectors.select(*(F.col(f"`{c}`") for c in rest), F.col(f"`{column}`").cast("array<double>").alias("__v"))
    k = len(model.eigenvalues)
    schema = frame.drop("__v").schema.add(whitened, T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, y = whole_entries(batch.column(len(rest)), model.dims)
            out = batch.select(rest).take(pa.array(rows))
            ends = pa.array(np.arange(len(rows) + 1) * k, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.ListArray.from_arrays(ends, model.project(y).ravel())], [*rest, whitened]
            )

    return frame.mapInArrow(run, schema) if k else spark.createDataFrame([], schema)


def identity_error(vectors: DataFrame, model: Whitening, column: str = "embedding") -> float:
    """Largest absolute entry of (covariance of all whitened vectors) - identity, measured by another pass."""
    k = len(model.eigenvalues)
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Moments(k)
        for batch in batches:
            seen.add(model.project(whole_entries(batch.column(0), model.dims)[1]))
        yield from seen.rows()

    n, _, products = merged(_vectors(vectors, column).mapInArrow(run, _MOMENTS), k)
    return float(np.abs(products / n - np.eye(k)).max())


_DIGEST = "vec_id long, component int, deviation long, deviation_wide decimal(38,0), whitened double, explained double"


def digests(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component: the contract's columns."""
    model = fit(embeddings, components=components)
    error = identity_error(embeddings, model)
    k = len(model.eigenvalues)
    spark = embeddings.sparkSession
    if k:
        explained = model.eigenvalues / model.trace

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, y = whole_entries(batch.column(1), model.dims)
                far = model.deviations(y)
                fits = pa.array([v if v < 1 << 63 else None for v in far], pa.int64())
                wide = pa.array([v if v < 10**38 else None for v in far], pa.decimal128(38, 0))
                each = np.repeat(np.arange(len(rows)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows[each])),
                        pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()),
                        fits.take(pa.array(each)),
                        wide.take(pa.array(each)),
                        pa.array(model.project(y).ravel()),
                        pa.array(np.tile(explained, len(rows))),
                    ],
                    ["vec_id", "component", "deviation", "deviation_wide", "whitened", "explained"],
                )

        rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
        out = rows.mapInArrow(run, _DIGEST)
    else:
        out = spark.createDataFrame([], _DIGEST)
    return out.select(
        "vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", "explained",
        F.lit(error).alias("identity_error"), "deviation_wide",
    )
