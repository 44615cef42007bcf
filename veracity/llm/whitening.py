"""Embedding whitening (11): distributed centred covariance, leading eigenvectors, projection.

Spark sums one matrix of d x d entries over all rows; the driver sees that matrix alone.
Its leading eigenvalues come from a Householder tridiagonal form by bisection on Sturm
counts, their vectors by inverse iteration with reorthogonalisation within clusters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.llm.common import checkpoint

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
EPS = np.finfo(float).eps
#: Largest x, so that x + SHIFT is a long.
LIMIT = 2.0 ** 62


# ----------------------------------------------------------------------------- eigenvectors


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and reflectors of the Householder form of a symmetric matrix."""
    a = np.array(v, float)
    d = len(a)
    reflectors = []
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        scale = np.abs(x).max()
        u = np.zeros(d - k - 1)
        if scale and np.abs(x[1:]).max():
            x /= scale
            x[0] += np.copysign(np.sqrt(x @ x), x[0])
            u = x / np.sqrt(x @ x)
            rest = a[k + 1:, k + 1:]
            p = rest @ u
            w = 2 * (p - (u @ p) * u)
            rest -= np.outer(u, w) + np.outer(w, u)
            head = a[k + 1:, k]
            a[k + 1:, k] = a[k, k + 1:] = head - 2 * u * (u @ head)
        reflectors.append(u)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def count_below(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues are below each of ``at``."""
    tiny = EPS * EPS * max(float(np.abs(diag).max()), float(np.abs(off).max(initial=0.0)), 1e-300)
    q = diag[0] - at
    n = (q < 0).astype(int)
    for k in range(1, len(diag)):
        q = diag[k] - at - off[k - 1] ** 2 / np.where(np.abs(q) < tiny, -tiny, q)
        n += q < 0
    return n


def leading_values(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, all bisected at once."""
    d = len(diag)
    reach = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    lo = np.full(k, (diag - reach).min())
    hi = np.full(k, (diag + reach).max())
    hi += EPS * np.abs(hi) + 1e-300
    wanted = d - np.arange(k)  # the i-th largest is the (d - i)-th from below
    for _ in range(2100):  # beyond the steps from the largest double to the smallest
        mid = lo + (hi - lo) / 2
        open_ = (mid > lo) & (mid < hi)
        if not open_.any():
            break
        below = count_below(diag, off, mid) >= wanted
        hi = np.where(open_ & below, mid, hi)
        lo = np.where(open_ & ~below, mid, lo)
    return lo + (hi - lo) / 2


def _solve(diag: np.ndarray, off: np.ndarray, value: float, rhs: np.ndarray, least: float) -> np.ndarray:
    """Solve (tridiagonal - value) x = rhs by elimination with row exchanges."""
    d = len(diag)
    a, b, c = (diag - value).tolist(), off.tolist() + [0.0], [0.0] * d
    x = rhs.tolist()
    for k in range(d - 1):
        low, diag_next, up_next = float(off[k]), a[k + 1], b[k + 1]
        if abs(low) > abs(a[k]):
            a[k], low = low, a[k]
            b[k], diag_next = diag_next, b[k]
            c[k], up_next = up_next, 0.0
            x[k], x[k + 1] = x[k + 1], x[k]
        if a[k] == 0:
            a[k] = least
        f = low / a[k]
        a[k + 1], b[k + 1] = diag_next - f * b[k], up_next - f * c[k]
        x[k + 1] -= f * x[k]
    if abs(a[-1]) < least:
        a[-1] = least
    x[-1] /= a[-1]
    if d > 1:
        x[-2] = (x[-2] - b[-2] * x[-1]) / a[-2]
    for k in range(d - 3, -1, -1):
        x[k] = (x[k] - b[k] * x[k + 1] - c[k] * x[k + 2]) / a[k]
    return np.array(x)


def leading(v: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and unit vectors as columns.

    Values closer than a thousandth of the norm are a cluster: their vectors are
    orthogonalised against each other at every step of the inverse iteration.
    """
    d = len(v)
    k = min(k, d)
    size = float(np.abs(v).max(initial=0.0))
    if not size:
        return np.zeros(k), np.eye(d)[:, :k]
    diag, off, reflectors = tridiagonal(v / size)
    norm = float((np.abs(diag) + np.abs(np.append(off, 0)) + np.abs(np.append(0, off))).max())
    values = leading_values(diag, off, k)
    least = EPS * norm
    rng = np.random.default_rng(0)  # the start vectors; any will do
    found: list[np.ndarray] = []
    cluster = 0
    shift = np.inf
    for i, value in enumerate(values):
        if i and values[i - 1] - value > 1e-3 * norm:
            cluster = i
        # equal values must not give the same matrix again
        shift = min(value, shift - 2 * least) if i > cluster else value
        x = rng.uniform(0.5, 1.0, d) * np.where(rng.random(d) < 0.5, -1, 1)
        for _ in range(6):
            x = _solve(diag, off, shift, x / np.abs(x).max(), least)
            for _ in range(2):
                x /= np.sqrt(x @ x)
                for other in found[cluster:]:
                    x -= (other @ x) * other
            x /= np.sqrt(x @ x)
        found.append(x)
    vectors = np.array(found).T
    for j in range(len(reflectors) - 1, -1, -1):
        u = reflectors[j]
        vectors[j + 1:] -= 2 * np.outer(u, u @ vectors[j + 1:])
    # the values again from the vectors, which is more exact than the tridiagonal form
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# ----------------------------------------------------------------------------- fit


@dataclass(frozen=True)
class Whitening:
    """Fitted on ``n`` distinct vectors: sums per dimension, eigenvalues, components as columns."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def matrix(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def quantised(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``rows`` with ``x``, an array of longs: floor(64 c) + 1000000 of every entry c.

    Rows go whose vector is null or empty, or holds null or non-finite entries or such beyond 2^56.
    """
    c = F.col(vector).cast("array<double>")
    fits = F.forall(c, lambda e: F.coalesce(F.abs(e) < LIMIT / SCALE, F.lit(False)))  # not so for NaN, which is largest
    x = F.transform(c, lambda e: F.floor(e * SCALE).cast("long") + SHIFT)
    return rows.where(c.isNotNull() & (F.size(c) > 0) & fits).withColumn("x", x)


def _matrix(array: pa.Array, d: int) -> np.ndarray:
    return pc.list_flatten(array).to_numpy(zero_copy_only=False).reshape(-1, d)


def centred(x: np.ndarray, n: int, sums: np.ndarray, base: np.ndarray) -> np.ndarray:
    """n * x - S as longs, for ``base`` = floor(S / n) and ``sums`` = S - n * base."""
    return n * (x - base) - sums


def _split(n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    base = [s // n for s in sums]
    return np.array([s - n * b for s, b in zip(sums, base, strict=True)], np.int64), np.array(base, np.int64)


def _gram(fit: DataFrame, d: int, size: int, rows_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of r' r over the rows ``r`` that ``rows_of`` makes of the vectors.

    A task sends the upper half of one matrix, summed by Spark entry by entry.
    """
    i, j = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for b in batches:
            r = rows_of(_matrix(b.column(0), d))
            total += r.T @ r
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "v"])

    sums = fit.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((size, size))
    a, b, v = (sums[c].to_numpy() for c in ("i", "j", "v"))
    out[a, b] = out[b, a] = v
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on every distinct ``x`` of ``vectors`` once; None without any.

    The driver gets one row per dimension and one d x d matrix, whatever the number of rows.
    The vectors must have one length (``whiten`` sees to it).  Components whose eigenvalue is
    zero but for rounding have no whitened value and are left out.
    """
    fit_list = checkpoint(vectors.select("x").distinct())
    first = fit_list.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d = first["d"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for b in batches:
            x = _matrix(b.column(0), d)
            n += len(x)
            low = x & 0xFFFFFFFF  # in two halves, so that no sum of longs overflows
            total = [t + (h << 32) + k for t, h, k in zip(total, (x >> 32).sum(0).tolist(), low.sum(0).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(map(str, total))], ["i", "n", "s"])

    # decimal sums are exact
    total = F.sum(F.col("s").cast("decimal(28,0)")).alias("s")
    per_dim = fit_list.mapInArrow(run, "i int, n long, s string").groupBy("i").agg(F.sum("n").alias("n"), total)
    got = sorted(per_dim.collect(), key=lambda r: r["i"])
    n, sums = got[0]["n"], tuple(int(r["s"]) for r in got)
    rest, base = _split(n, sums)

    def deviations(x: np.ndarray) -> np.ndarray:
        return (x - base).astype(float) - rest / n

    v = _gram(fit_list, d, d, deviations) / n
    values, vectors_ = leading(v, components)
    trace = float(np.trace(v))
    keep = values > d * EPS * max(trace, 0.0)
    values, vectors_ = values[keep], vectors_[:, keep]
    matrix = vectors_ / np.sqrt(values)
    error = 0.0
    if len(values):
        whitened = _gram(fit_list, d, len(values), lambda x: deviations(x) @ matrix) / n
        error = float(np.abs(whitened - np.eye(len(values))).max())
    return Whitening(n, sums, values, vectors_, trace, error)


def whiten(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows without a usable vector (see ``quantised``) are dropped.  If lengths differ, the length
    that most rows have is the dimension (of equally many the larger), and rows of other lengths
    are dropped too.  Repeated rows and ids stay as often as they come; equal vectors count once in
    the fit.  ``deviation`` is null where the exact number is no long.  Without usable vectors, or
    if all are equal, the result is empty.  Other columns are not read.
    """
    usable = quantised(rows.select(F.col(id_col).alias("vec_id"), F.col(vector).alias("_v")), "_v").select("vec_id", "x")
    length = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    kind = usable.schema["vec_id"]
    schema = T.StructType([
        kind, T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    model = None
    if length is not None:
        usable = usable.where(F.size("x") == length["d"])
        model = fit(usable, components)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    d = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        rest, base = _split(m.n, m.sums)
        k = len(m.values)
        explained = m.values / m.trace
        for b in batches:
            x = _matrix(b.column(1), d)
            size = np.abs((x - base).astype(float)) * m.n + m.n
            fits = (size ** 2).sum(1) < 2.0 ** 62
            out = centred(x, m.n, rest, base)
            out[~fits] = 0
            deviation = (out * out).sum(1).tolist()
            for i in np.flatnonzero(~fits).tolist():  # beyond the safe range: exact, one by one
                exact = sum((m.n * int(e) - s) ** 2 for e, s in zip(x[i], m.sums, strict=True))
                deviation[i] = exact if exact < 2 ** 63 else None
            whitened = ((x - base).astype(float) - rest / m.n) @ m.matrix
            rows_ = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(rows_)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                pa.array(np.full(len(rows_), m.n), pa.int64()), pa.array(deviation, pa.int64()).take(pa.array(rows_)),
                pa.array(whitened.ravel()), pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(rows_), m.identity_error))], schema.names)

    return usable.mapInArrow(run, schema)
