"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on its factor.

Entries become integers ``floor(scale * entry) + shift``. The fit list is every distinct integer vector once; its
count n and sums S are exact. The scatter is gathered around the whole numbers next to the mean, as
integer products summed per task and then per entry, and the remaining rank-one term is taken off in
integers, so the covariance is correctly rounded and does not depend on the order of tasks. Only matrices of
dimension x dimension reach the driver.

There the covariance is factored as L L' with pivoting (the largest remaining diagonal entry first); plane
rotations of pairs of L's columns make them orthogonal. Then the squares of the column norms are
the eigenvalues and the normalised columns the components: L = U D W' gives L L' = U D^2 U'. The largest entry of a
component is positive. Columns with no variance beyond rounding (1e-13 of the largest) are no components.

Defined results: rows with a null vector, an empty one, or null or non-finite entries are dropped; all
others are returned, repeated rows and null ids included. Vectors of different lengths, entries beyond
2^52 and a deviation beyond 2^63 raise. An empty table, or one with a single distinct vector, has no component and gives no row. Extra
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import table

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
RANK_TOLERANCE = 1e-13
_EXACT = 1 << 53


# ---- the dense steps on a dimension x dimension matrix -----------------------------------------

def pivoted_cholesky(v: np.ndarray, tolerance: float = RANK_TOLERANCE) -> np.ndarray:
    """L (rows in the order of ``v``, one column per pivot) with L L' = v up to the tolerance."""
    d = len(v)
    left = np.diag(v).astype(float).copy()
    cols: list[np.ndarray] = []
    used = np.zeros(d, bool)
    limit = tolerance * max(float(left.max(initial=0.0)), 0.0)
    for _ in range(d):
        p = int(np.argmax(np.where(used, -np.inf, left)))
        if left[p] <= limit:
            break
        col = v[:, p] - sum((c * c[p] for c in cols), np.zeros(d))
        pivot = np.sqrt(col[p])
        col = np.where(used, 0.0, col / pivot)
        col[p] = pivot
        used[p] = True
        left = left - col * col
        cols.append(col)
    return np.array(cols).T if cols else np.zeros((d, 0))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as columns) of factor @ factor.T by rotating its columns, eigenvalues falling."""
    a = factor.copy()
    r = a.shape[1]
    for _ in range(sweeps):
        worst = 0.0
        for i in range(r - 1):
            for j in range(i + 1, r):
                x, y = a[:, i], a[:, j]
                p, q, s = x @ x, y @ y, x @ y
                if s == 0.0 or p == 0.0 or q == 0.0:
                    continue
                off = abs(s) / np.sqrt(p * q)
                worst = max(worst, off)
                if off <= 1e-16:
                    continue
                z = (q - p) / (2 * s)
                t = np.copysign(1.0, z) / (abs(z) + np.hypot(1.0, z))
                c = 1 / np.hypot(1.0, t)
                a[:, i], a[:, j] = c * x - c * t * y, c * t * x + c * y
        if worst <= 1e-14:
            break
    else:
        raise RuntimeError("Jacobi rotations did not settle")
    norms = np.sqrt((a * a).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    comp = a[:, order] / norms[order]
    sign = np.sign(comp[np.argmax(np.abs(comp), axis=0), np.arange(comp.shape[1])])
    return norms[order] ** 2, comp * sign


# ---- distributed sums --------------------------------------------------------------------------

def integer_vectors(rows: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, v): v the bytes of floor(scale * entry) as 64-bit integers; unusable rows are left out."""
    src = rows.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    schema = T.StructType([src.schema["vec_id"], T.StructField("v", T.BinaryType())])

    def run(batches):
        for batch in batches:
            ids, vals = [], []
            for k, flat in _usable(batch.column(1)):
                x = np.floor(scale * flat)
                if np.abs(x).max() >= 1 << 52:
                    raise ValueError("entries beyond 2^52 have no exact place on the grid")
                ids.append(k)
                vals.append(x.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), pa.array(vals, pa.binary())], names=["vec_id", "v"])

    return src.mapInArrow(run, schema)


def _usable(column):
    """(row, entries) of the vectors that are not null or empty and hold finite numbers only."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)  # null entries are NaN
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for k in np.flatnonzero(valid).tolist():
        x = flat[offsets[k]:offsets[k + 1]]
        if len(x) and np.isfinite(x).all():
            yield k, x


def _matrix(column, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, d)


def _products(y: np.ndarray) -> np.ndarray:
    """y' y, exact: in doubles where all sums stay below 2^53, else in Python integers."""
    top = int(np.abs(y).max(initial=0))
    if top * top * len(y) < _EXACT:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    big = y.astype(object)
    return big.T @ big


def scatter(fit: DataFrame, centre: list[int], d: int) -> np.ndarray:
    """Exact sums (Python integers) of the products of entries minus ``centre`` over all vectors."""
    c = np.array(centre, np.int64)

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                p = _products(_matrix(batch.column(0), d) - c)
                total = p if total is None else total + p
        if total is not None:
            i, j = np.triu_indices(d)
            from decimal import Decimal
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array([Decimal(int(x)) for x in total[i, j]], pa.decimal128(38, 0))], names=["i", "j", "s"])

    sums = fit.select("v").mapInArrow(run, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    out = np.zeros((d, d), object)
    for r in sums:
        out[r.i, r.j] = out[r.j, r.i] = int(r.s)
    return out


def counted(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension."""
    def run(batches):
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            if batch.num_rows:
                n += batch.num_rows
                total = total + _matrix(batch.column(0), d).astype(object).sum(axis=0)
        if n:
            from decimal import Decimal
            yield pa.RecordBatch.from_arrays([pa.array([-1, *range(d)], pa.int32()),
                                              pa.array([Decimal(int(x)) for x in (n, *total)], pa.decimal128(38, 0))], names=["i", "s"])

    sums = {r.i: int(r.s) for r in fit.select("v").mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    return sums.get(-1, 0), [sums.get(i, 0) for i in range(d)]


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance (divisor n), each entry rounded once from its exact value."""
    d = len(sums)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]
    a = scatter(fit, centre, d)
    return np.array([[(n * a[i, j] - rest[i] * rest[j]) / (n * n) for j in range(d)] for i in range(d)], float)


def _whitened(v: np.ndarray, n: int, sums: list[int], matrix: np.ndarray) -> np.ndarray:
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    off = np.array([(s - n * int(c)) / n for s, c in zip(sums, centre)])
    return ((v - centre).astype(float) - off) @ matrix


def fit_components(fit: DataFrame, d: int, components: int = COMPONENTS):
    """(n, sums, eigenvalues, components, trace) of the distinct vectors ``fit`` (column v)."""
    n, sums = counted(fit, d)
    v = covariance(fit, n, sums)
    values, comp = one_sided_jacobi(pivoted_cholesky(v))
    return n, sums, values[:components], comp[:, :components], float(np.trace(v))


def identity_error(fit: DataFrame, n: int, sums: list[int], matrix: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    d, k = matrix.shape

    def run(batches):
        total = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                w = _whitened(_matrix(batch.column(0), d), n, sums, matrix)
                total[:k] += w.T @ w
                total[k] += w.sum(axis=0)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "s"])

    total = np.zeros((k + 1, k))
    for r in fit.select("v").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        total[r.i, r.j] = r.s
    mean = total[k] / n
    return float(np.abs(total[:k] / n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT,
           components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per usable row and component.

    deviation is the exact sum of (n * x - S)^2 over the dimensions; the constant ``shift`` of x cancels in it, in the
    covariance and in the projections, so it is never added."""
    vectors = table(integer_vectors(rows, vec_id, vector, scale), "integer-vectors")
    schema = T.StructType([vectors.schema["vec_id"], *[T.StructField(*f) for f in (
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()),
        ("explained", T.DoubleType()), ("identity_error", T.DoubleType()))]])
    lengths = vectors.agg(F.min(F.octet_length("v")).alias("lo"), F.max(F.octet_length("v")).alias("hi")).first()
    if lengths.hi is None:
        return vectors.sparkSession.createDataFrame([], schema)
    if lengths.lo != lengths.hi:
        raise ValueError("vectors differ in length")
    d = lengths.hi // 8
    fit = table(vectors.select("v").distinct(), "fit-list")
    n, sums, values, comp, trace = fit_components(fit, d, components)
    k = len(values)
    if not k:
        return vectors.sparkSession.createDataFrame([], schema)
    matrix = comp / np.sqrt(values)
    error = identity_error(fit, n, sums, matrix)
    explained = values / trace

    def run(batches):
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            v = _matrix(batch.column(1), d)
            w = _whitened(v, n, sums, matrix)
            far = deviations(v, n, sums)
            at = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                pa.array(np.repeat(far, k)), pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=[f.name for f in schema])

    return vectors.mapInArrow(run, schema)


def deviations(v: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Exact sums of (n * x - S)^2 over the dimensions, as 64-bit integers."""
    d = v.shape[1]
    top = n * int(np.abs(v).max()) + max(map(abs, sums))
    if d * top * top < 1 << 63:
        x = n * v - np.array(sums, np.int64)
        return (x * x).sum(axis=1)
    x = v.astype(object) * n - np.array(sums, object)
    exact = (x * x).sum(axis=1)
    if max(exact) >= 1 << 63:
        raise OverflowError("a deviation is beyond 64 bits")
    return exact.astype(np.int64)
