"""Embedding whitening by a bidiagonal qd solver.

Vectors become exact integers, ``x = floor(64 c) + 1000000``; the distinct ones
are the fit list. Their count and sums centre every row exactly before anything
is multiplied. Tasks reduce blocks of centred rows by QR, and triangles are
stacked and reduced again, so only one d x d triangle R reaches the driver
(d: the dimension). No covariance matrix is formed:

* Householder reflections bring R to an upper bidiagonal B;
* dqds finds B's singular values to high relative accuracy;
* twisted factorisations of B'B - s^2 I, built from differential qd transforms
  from both ends, give B's right singular vectors, and the reflections turn
  them into the unit eigenvectors of the covariance R'R / n.

A last pass over the fit list measures how far the covariance of the whitened
rows is from the identity.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import save

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
BLOCK_ROWS = 2048           # rows of a QR block
FAN_IN = 16                 # triangles stacked by one task
_EPS = np.finfo(float).eps
_LONG = 2**63 - 1


# ------------------------------------------------------------ dense kernels
def triangle(rows: np.ndarray) -> np.ndarray:
    """R of the rows' QR decomposition, padded to d x d."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))])


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B and the orthogonal P with R = U B P'."""
    a, d = r.astype(float).copy(), r.shape[1]
    p = np.eye(d)

    def reflector(v):
        size = np.abs(v).max(initial=0)
        if size == 0:
            return None
        w = v / size
        w[0] += np.copysign(np.linalg.norm(w), w[0])
        return w / np.linalg.norm(w)

    for k in range(d):
        if (w := reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(w, w @ a[k:, k:])
        if k + 2 < d and (w := reflector(a[k, k + 1:])) is not None:
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ w, w)
            p[:, k + 1:] -= 2 * np.outer(p[:, k + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), p


def _dqds(q: list[float], e: list[float], shift: float):
    """One differential qd transform with shift; None if a pivot is negative."""
    n = len(q)
    q2, e2 = [0.0] * n, [0.0] * (n - 1)
    d = least = q[0] - shift
    for k in range(n - 1):
        if d < 0:
            return None
        q2[k] = d + e[k]
        if q2[k] == 0:
            e2[k], d = 0.0, q[k + 1] - shift
        else:
            e2[k], d = q[k + 1] * (e[k] / q2[k]), q[k + 1] * (d / q2[k]) - shift
        least = min(least, d)
    q2[-1] = d
    return None if d < 0 or least < 0 else (q2, e2, least)


def singular_values(diag: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Singular values of the bidiagonal, falling, by dqds.

    Arrays are split where an off-diagonal entry is negligible against its
    neighbours. A shift is a guess at the smallest eigenvalue left; if it was
    too large the transform is made again with less, at last with none, which
    never fails.
    """
    out: list[float] = []
    stack = [([float(v) ** 2 for v in diag], [float(v) ** 2 for v in off], 0.0)]
    while stack:
        q, e, moved = stack.pop()
        if len(q) < 2:
            out += [v + moved for v in q]
            continue
        if q[0] < q[-1]:        # the reversed array has the same values; small ones should be at the end
            q, e = q[::-1], e[::-1]
        least = None
        while True:
            cut = next((k for k in range(len(e) - 1, -1, -1)
                        if e[k] <= _EPS**2 * (moved + min(q[k], q[k + 1])) or e[k] <= _EPS**2 * q[k + 1]), None)
            if cut is not None:
                stack += [(q[:cut + 1], e[:cut], moved), (q[cut + 1:], e[cut + 1:], moved)]
                break
            shift = max(0.0, _guess(q, e, least))
            while (step := _dqds(q, e, shift)) is None:
                shift = shift / 4 if shift > 1e-3 * min((v for v in q if v > 0), default=0) else 0.0
            q, e, least = step
            moved += shift
    return np.sqrt(np.sort(out)[::-1])


def _guess(q: list[float], e: list[float], least: float | None) -> float:
    """Just below the smaller eigenvalue of the last two by two block of B B',
    or the last transform's least pivot, if that is less."""
    a, b2, c = q[-2] + e[-1], q[-1] * e[-1], q[-1]
    half = (a - c) / 2
    root = (half * half + b2) ** 0.5
    lower = c + half - root if half < root else c - b2 / (half + root)
    return 0.999 * min(lower, lower if least is None else least)


def twisted_vector(diag: np.ndarray, off: np.ndarray, value: float, start: np.ndarray | None = None) -> np.ndarray:
    """Unit right singular vector of the bidiagonal for singular value ``value``.

    T = B'B is taken as L D L' from B itself; the stationary transform gives
    T - s^2 = L+ D+ L+', the progressive one U- D- U-'. Where their twisted
    combination has its smallest pivot, the vector is read off both ways. With
    ``start`` one step of inverse iteration through that factorisation is made
    instead (for values so close that several vectors belong to them).
    """
    n, lam = len(diag), float(value) ** 2
    tiny = max(float(np.max(diag**2, initial=0)), lam, 1e-300) * _EPS**2
    d0 = diag**2
    low = np.divide(off, diag[:-1], out=np.zeros(n - 1), where=diag[:-1] != 0)      # L's subdiagonal
    dplus, lplus, s = np.zeros(n), np.zeros(n - 1), np.zeros(n)
    s[0] = -lam
    for k in range(n - 1):
        dplus[k] = s[k] + d0[k] or tiny
        lplus[k] = d0[k] * low[k] / dplus[k]
        s[k + 1] = lplus[k] * low[k] * s[k] - lam
    dplus[-1] = s[-1] + d0[-1] or tiny
    dminus, uminus, p = np.zeros(n), np.zeros(n - 1), np.zeros(n)
    p[-1] = d0[-1] - lam
    for k in range(n - 2, -1, -1):
        dminus[k + 1] = d0[k] * low[k] ** 2 + p[k + 1] or tiny
        t = d0[k] / dminus[k + 1]
        uminus[k] = low[k] * t
        p[k] = p[k + 1] * t - lam
    gamma = s + p + lam
    r = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    if start is None:
        z[r] = 1
        for k in range(r - 1, -1, -1):
            z[k] = -lplus[k] * z[k + 1]
        for k in range(r, n - 1):
            z[k + 1] = -uminus[k] * z[k]
    else:       # N D N' z = start, N twisted at r
        y = start.copy()
        for k in range(r):
            y[k + 1] -= lplus[k] * y[k]
        for k in range(n - 1, r, -1):
            y[k - 1] -= uminus[k - 1] * y[k]
        pivot = np.concatenate([dplus[:r], [gamma[r] or tiny], dminus[r + 1:]])
        z = y / np.where(pivot == 0, tiny, pivot)
        for k in range(r - 1, -1, -1):
            z[k] -= lplus[k] * z[k + 1]
        for k in range(r, n - 1):
            z[k + 1] -= uminus[k] * z[k]
    return z / np.linalg.norm(z)


def directions(r: np.ndarray, count: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of R (all, falling) and the first right singular vectors
    (columns; at most ``count``, none for values that are rounding noise)."""
    d = r.shape[1]
    if d == 0:
        return np.zeros(0), np.zeros((0, 0))
    size = np.abs(r).max(initial=0)
    if size == 0:
        return np.zeros(d), np.zeros((d, 0))
    diag, off, p = bidiagonalise(r / size)
    # Unreduced blocks: vectors of different blocks are orthogonal as they are.
    norm = max(np.abs(diag).max(), np.abs(off).max(initial=0))
    ends = [0, *(np.flatnonzero(np.abs(off) <= _EPS * norm) + 1), d]
    pairs = []
    for a, b in zip(ends, ends[1:]):
        pairs += [(v, a, b) for v in singular_values(diag[a:b], off[a:b - 1])]
    pairs.sort(key=lambda x: -x[0])
    values = np.array([v for v, _, _ in pairs])
    wanted = pairs[:min(count, int((values > d * _EPS * values[0]).sum()))]
    out = np.zeros((d, len(wanted)))
    for k, (v, a, b) in enumerate(wanted):
        near = [j for j in range(k) if wanted[j][1] == a and wanted[j][0] ** 2 - v**2 <= 1e-3 * values[0] ** 2]
        # Where a diagonal entry is lost, B'B has no L D L': it is lifted to rounding noise.
        lifted = np.where(np.abs(diag[a:b]) < _EPS**2 * norm, _EPS**2 * norm, diag[a:b])
        out[a:b, k] = _vector(lifted, off[a:b - 1], v, out[a:b, near])
    return values * size, p @ out


def _vector(diag: np.ndarray, off: np.ndarray, value: float, near: np.ndarray) -> np.ndarray:
    """Right singular vector for ``value``, orthogonal to the columns of ``near``."""
    def apart(v):
        for _ in range(2):
            v = v - near @ (near.T @ v)
        return v

    z = apart(twisted_vector(diag, off, value))
    if np.linalg.norm(z) < 0.5:     # an earlier vector again: inverse iteration beside them
        z = apart(np.random.default_rng(near.shape[1]).normal(size=len(diag)))
        for _ in range(4):
            z = apart(twisted_vector(diag, off, value, z / np.linalg.norm(z)))
    return z / np.linalg.norm(z)


# ------------------------------------------------------------ the operator
def integer_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, x`` of the rows kept: no null, non-finite or unfit entry."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(2**56)))
    return df.where(F.col(vec_col).isNotNull()).where(fine) \
        .select(F.col(id_col).alias("id"), F.transform(v, lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _centred(x: np.ndarray, n: int, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact n x - S as integers (Python's, where 64 bits might not hold them)
    and x - S/n as doubles."""
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, map(int, total)), default=0)
    if reach < 2**62:
        whole = n * x - total.astype(np.int64)
    else:
        whole = n * x.astype(object) - total
    return whole, (whole / n).astype(float)


def _sums(it):
    for b in it:
        if b.num_rows:
            x = _matrix(b.column(0))
            wide = x.astype(object) if int(np.abs(x).max(initial=0)) * len(x) >= 2**62 else x
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(x)], pa.int64()), pa.array([[str(v) for v in wide.sum(axis=0)]], pa.list_(pa.string()))],
                names=["n", "sums"])


def _reduced(found: DataFrame) -> np.ndarray:
    """One triangle of rows ``part, r`` by stacking FAN_IN of them at a time."""
    def stack(key, group):
        parts = [np.frombuffer(v) for v in group.sort_values("part")["r"]]
        d = int(round(len(parts[0]) ** 0.5))
        r = triangle(np.vstack([p.reshape(d, d) for p in parts]))
        return pd.DataFrame({"part": [key[0]], "r": [r.tobytes()]})

    found = save(found, "triangles")
    while (n := found.count()) > 1:
        found = save(found.groupBy(F.expr(f"part div {FAN_IN}").alias("k")).applyInPandas(stack, "part long, r binary"),
                     "triangles")
    r = np.frombuffer(found.first().r)
    return r.reshape(int(round(len(r) ** 0.5)), -1)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """Per kept row and component: ``id_col, component, n, deviation, whitened,
    explained, identity_error``.

    Rows with a null vector or a null, non-finite or unfit entry (2^56 or more)
    are left out. So are rows whose vector has another length than most have
    (of equal counts the longer), and empty vectors. Equal vectors count once in
    the fit, each row is returned. Null and repeated ids are returned like
    others; no other column is read. There are as many components as the fit
    list has directions with variance: fewer than two distinct vectors and an
    empty table give no row. ``deviation`` is exact, null beyond a long.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("component", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
                           *(T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error"))])
    empty = spark.createDataFrame([], schema)
    rows = integer_vectors(vectors, id_col, vec_col)
    usual = rows.where(F.size("x") > 0).groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if usual is None:
        return empty
    rows = rows.where(F.size("x") == usual.d)
    fit = save(rows.select("x").distinct(), "fit-list")
    # Sums per batch are added per dimension in Spark as whole numbers of 38 digits.
    sums = fit.mapInArrow(_sums, "n long, sums array<string>")
    n = fit.count()
    total = sums.select(F.posexplode("sums")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s")) \
        .orderBy("pos").collect()                           # one row a dimension
    total = np.array([int(r.s) for r in total], object)

    def blocks(it):
        r = None
        for b in it:
            for k in range(0, b.num_rows, BLOCK_ROWS):
                rows_ = _centred(_matrix(b.column(0).slice(k, BLOCK_ROWS)), n, total)[1]
                r = triangle(rows_ if r is None else np.vstack([r, rows_]))
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              pa.array([r.tobytes()], pa.binary())], names=["part", "r"])

    r = _reduced(fit.mapInArrow(blocks, "part long, r binary"))
    values, axes = directions(r, components)
    k = axes.shape[1]
    if k == 0:
        return empty
    variance = values**2 / n
    to_white = axes / np.sqrt(variance[:k])
    explained = variance[:k] / variance.sum()

    def products(it):
        gram, mean = np.zeros((k, k)), np.zeros(k)
        for b in it:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                z = _centred(_matrix(b.column(0).slice(at, BLOCK_ROWS)), n, total)[1] @ to_white
                gram += z.T @ z
                mean += z.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([[*gram.ravel(), *mean]], pa.list_(pa.float64()))], names=["v"])

    added = fit.mapInArrow(products, "v array<double>").select(F.posexplode("v")).groupBy("pos").agg(F.sum("col").alias("s"))
    added = np.array([row.s for row in added.orderBy("pos").collect()]) / n     # k * k + k rows
    covariance = added[:k * k].reshape(k, k) - np.outer(added[k * k:], added[k * k:])
    error = float(np.abs(covariance - np.eye(k)).max())
    out = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def project(it):
        for b in it:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(at, BLOCK_ROWS)
                m = part.num_rows
                whole, centred = _centred(_matrix(part.column(1)), n, total)
                if whole.dtype != object and int(np.abs(whole).max(initial=0)) ** 2 * whole.shape[1] > _LONG:
                    whole = whole.astype(object)
                deviation = [v if v <= _LONG else None for v in (whole * whole).sum(axis=1).tolist()]
                ids = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(ids)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)), pa.array(deviation, pa.int64()).take(pa.array(ids)),
                    pa.array((centred @ to_white).ravel()), pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error))], schema=out)

    return rows.mapInArrow(project, schema)
