"""K-nearest-neighbour joins and the kNN classifiers.

Exact, in two phases over rings of cells:

1. Equal train vectors become one class that keeps its k smallest ids, so a
   hot vector is one row.
2. ``P`` pivots = the classes with the smallest digests (a bounded top-P, about
   one a block of classes);
   every class goes to the cell of its nearest pivot, with radius r. A cell is
   cut by radius into at most RINGS rings; a ring is dealt by hash to blocks of
   about BLOCK classes.
3. First phase: each query meets only the rings of its own cell next to its own
   radius that hold k classes (further cells only where the own one holds
   fewer). The k-th distance found is theta, a true bound.
4. Second phase: of a query with pivot distances dq, only rings that can hold
   something within theta are met: a class x of cell c at radius r has
   ``d(q, x) >= |dq[c] - r|`` and, c being its nearest pivot,
   ``d(q, x) >= (dq[c] - dq[own]) / 2``. Of many rings the NEAR_RINGS with the least
   such bounds are met first and theta is taken anew, so that the others yield few rows.
5. Both phases join blocks: queries of a ring are packed to blocks and equi-joined
   to the ring's train blocks on (ring, block, salt); busy rings are copied to
   several salts, so that a key meets at most SALT_BLOCKS query blocks. One row
   is a pair of blocks, not of vectors, and emits at most k classes per query.
   A matrix product in single precision (manhattan: sums in 16 bits) with a bound on
   its error orders a pair's distances; the few that may be among the k are computed
   exactly. Where the bound leaves many, the orders are taken again in a finer type.
6. A partial top-k per query merges the blocks.

Cosine is searched in the unit space with a trailing flag for zero vectors,
where it is monotone in euclidean distance. Ties at rank k are broken by the
smaller train id (T25).

``knn_join_approx`` is the approximate branch: random-projection hashing with
an audited recall.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import distance as D
from ..functions.exprs import digest, json_lit
from ..session import cut_lineage

MAX_PIVOTS = 1024
RINGS = 32                    # rings of a cell, at most
BLOCK = 8192                  # vectors of a block
FEW = 2 * BLOCK               # so few train classes are met whole, in one phase
SALT_BLOCKS = 16              # query blocks that one key of a block join meets, at most
NEAR_RINGS = 16               # rings that tighten a query's bound before it meets the others
SLACK = 1e-9
WEIGHT_GUARD = 1e-8          # fixed value: added to distances before they become weights
CHUNK_ELEMS = 1_000_000       # numpy working set per chunk (doubles)
TILE = 64                     # rows whose sums stay in the cache


# --------------------------------------------------- numpy helpers (in tasks)
def _mat(arr) -> np.ndarray:
    """Arrow list<double> column -> (n, d) float64 matrix without per-row
    Python objects. Vectors must be non-null and of equal length."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    if n == 0:
        return np.zeros((0, 0))
    if arr.null_count:
        raise ValueError("kNN vectors must not be NULL")
    off = arr.offsets.to_numpy()
    lens = np.diff(off)
    d = int(lens[0])
    if not np.all(lens == d):
        raise ValueError("kNN vectors must all have the same length")
    vals = arr.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(vals, dtype=np.float64).reshape(n, d)


def _ragged(rows: np.ndarray, vals: np.ndarray, n: int, dtype) -> pa.Array:
    """Lists from (row index, value) pairs sorted by row."""
    counts = np.bincount(rows, minlength=n)
    off = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(vals, type=dtype))


def _search_space(X: np.ndarray, metric: str) -> np.ndarray:
    """Cosine: unit vectors plus a trailing 0; zero vectors -> (0, ..., 0, 1)."""
    if metric != "cosine":
        return X
    n = np.linalg.norm(X, axis=1)
    U = X / np.where(n == 0, 1.0, n)[:, None]
    U[n == 0] = 0.0
    return np.hstack([U, (n == 0).astype(np.float64)[:, None]])


def _to_pivots(S: np.ndarray, piv: np.ndarray, metric: str) -> np.ndarray:
    """Exact (difference-based) distances of rows to the pivots, chunked."""
    out = np.empty((S.shape[0], piv.shape[0]))
    step = max(1, CHUNK_ELEMS // max(1, piv.size))
    for i in range(0, S.shape[0], step):
        diff = S[i:i + step, None, :] - piv[None, :, :]
        out[i:i + step] = (np.abs(diff).sum(-1) if metric == "manhattan"
                           else np.sqrt((diff * diff).sum(-1)))
    return out


def block_distances(A: np.ndarray, B: np.ndarray, metric: str) -> np.ndarray:
    """All distances of two blocks in search space, in bounded chunks."""
    out = np.empty((len(A), len(B)))
    step = max(1, CHUNK_ELEMS // max(1, B.size))
    for i in range(0, len(A), step):
        if metric == "cosine":      # unit vectors; a zero vector is at 1 from everything (T24)
            out[i:i + step] = 1.0 - A[i:i + step, :-1] @ B[:, :-1].T
        else:
            diff = A[i:i + step, None, :] - B[None, :, :]
            out[i:i + step] = np.abs(diff).sum(-1) if metric == "manhattan" else np.sqrt((diff * diff).sum(-1))
    return out


def _rough(X: np.ndarray, Y: np.ndarray, search: str, fine: bool):
    """``near(rows), shift, unit, error``: near orders the distances of some rows of X to all
    of Y; near * unit + shift of the row is a distance (euclidean: squared) within error * unit.
    Euclidean: one matrix product in single precision (fine: double). Manhattan: sums in whole
    numbers of 16 bits (fine: single precision). Both blocks are moved to the middle of Y. Values that these can't hold are compared exactly (error 0)."""
    n, d = X.shape
    with np.errstate(over="ignore", invalid="ignore"):
        middle = Y.mean(0)
        A, B = X - middle, Y - middle
        if search == "manhattan":
            a, b = np.abs(A).sum(1), np.abs(B).sum(1).max()
            fits = a.max() + b < 1e37
        else:
            a, b = (A * A).sum(1), (B * B).sum(1)
            fits = a.max() + b.max() < (1e300 if fine else 1e37)
    if not fits:        # also where something is NaN
        return lambda rows: block_distances(X[rows], Y, search), np.zeros(n), 1.0, np.zeros(n)
    if search == "manhattan":
        small = not fine and d <= 512 and a.max() + b > 1e-30
        kind, scale = (np.int16, 30_000 / (a.max() + b)) if small else (np.float32, 1.0)
        A, B = (np.rint(M * scale) if small else M for M in (A, B))
        A, B = A.astype(kind), np.ascontiguousarray(B.T, dtype=kind)

        def summed(rows):
            near = np.zeros((rows.stop - rows.start, B.shape[1]), dtype=kind)
            for i in range(0, len(near), TILE):
                here = near[i:i + TILE]
                step = np.empty_like(here)
                for x, y in zip(A[rows][i:i + TILE].T, B):
                    np.subtract(x[:, None], y[None, :], out=step)
                    np.abs(step, out=step)
                    here += step
            return near
        error = np.full(n, d + 1.0) if small else (a + b) * (4 * (d + 8) * float(np.finfo(kind).eps)) + 1e-30
        return summed, np.zeros(n), 1 / scale, error
    kind, times, least = (np.float64, 16, 1e-300) if fine else (np.float32, 4, 1e-30)
    left, right = np.hstack([A * -2, np.ones((n, 1))]).astype(kind), np.hstack([B, b[:, None]]).T.astype(kind)
    error = (a + b.max()) * (times * (d + 8) * float(np.finfo(kind).eps)) + least
    return lambda rows: left[rows] @ right, a, 1.0, error


def _upto(limit: np.ndarray, kind) -> np.ndarray:
    """Limits in the type of the orders, rounded up (whole numbers: down); NaN: nothing is within."""
    if kind == np.int16:
        return np.floor(np.clip(np.nan_to_num(limit, nan=-32768), -32768, 32767)).astype(kind)
    with np.errstate(over="ignore"):
        return np.nextafter(limit.astype(kind), kind.type(np.inf))


def _hits(order: np.ndarray, limit: np.ndarray, error: np.ndarray, kk: int):
    """(row, column) of the orders that may be among the row's kk least and are within its limit."""
    some = np.arange(len(order))
    if error.any():             # else there may be NaN
        some = np.flatnonzero(order.min(1) <= _upto(limit, order.dtype))
        if len(some) < len(order):
            order, limit, error = order[some], limit[some], error[some]
    hit = order <= _upto(limit, order.dtype)[:, None]
    many = np.flatnonzero(np.count_nonzero(hit, axis=1) > 4 * kk)
    if len(many) and kk < order.shape[1]:
        last = np.partition(order[many], kk - 1, axis=1)[:, kk - 1].astype(np.float64)
        most = np.fmin(limit[many], last + 2 * error[many])
        hit[many] = order[many] <= _upto(most, order.dtype)[:, None]
    r, c = np.divmod(np.flatnonzero(hit), order.shape[1])
    return some[r], c


def _top(X: np.ndarray, Y: np.ndarray, theta: np.ndarray, cid: np.ndarray, kk: int, search: str):
    """Of each row of X its kk nearest rows of Y within ``theta``, ties to the smaller
    ``cid``: (row, column, distance). Rough orders leave few pairs, whose distances are
    then computed from differences; where they leave many, finer ones are taken."""
    fine, bounds = False, None
    rows, cols = [], []
    step = max(1, CHUNK_ELEMS // 4 // len(Y))
    for i in range(0, len(X), step):
        part = slice(i, min(i + step, len(X)))
        while True:
            if bounds is None:
                near, shift, unit, error = _rough(X, Y, search, fine)
                squared = search == "euclidean" and bool(error.any())
                bounds = ((theta * theta if squared else theta) * (1 + SLACK) - shift) / unit + error
            r, c = _hits(near(part), bounds[part], error[part], kk)
            if fine or len(r) <= 6 * kk * (part.stop - i):
                break
            fine, bounds = True, None
        rows.append(r + i)
        cols.append(c)
    r, c = np.concatenate(rows), np.concatenate(cols)
    dist = np.empty(len(r))
    step = max(1, CHUNK_ELEMS // X.shape[1])
    for i in range(0, len(r), step):
        diff = X[r[i:i + step]] - Y[c[i:i + step]]
        dist[i:i + step] = np.abs(diff).sum(-1) if search == "manhattan" else np.sqrt((diff * diff).sum(-1))
    ok = np.flatnonzero(dist <= theta[r])
    ok = ok[np.lexsort((cid[c[ok]], dist[ok], r[ok]))]
    r, c, dist = r[ok], c[ok], dist[ok]
    few = np.arange(len(r)) - np.searchsorted(r, r) < kk
    return r[few], c[few], dist[few]


def _nearest(metric: str, kk: int):
    """Pairs of blocks -> per query the kk nearest classes within its bound, a batch a pair."""
    search = "manhattan" if metric == "manhattan" else "euclidean"

    def run(it):
        for b in it:
            for at in range(b.num_rows):
                q, t = (b.column(c).slice(at, 1).flatten() for c in ("q", "t"))
                if not len(q) or not len(t):
                    continue
                X, Y = (_search_space(_mat(side.field("v")), metric) for side in (q, t))
                qid, theta, cid = (side.field(c).to_numpy(zero_copy_only=False)
                                   for side, c in ((q, "id"), (q, "theta"), (t, "id")))
                i, j, near = _top(X, Y, theta, cid, kk, search)
                # unit vectors; a zero vector is at 1 from everything
                real = 1.0 - np.einsum("ij,ij->i", X[i, :-1], Y[j, :-1]) if metric == "cosine" else near
                yield pa.RecordBatch.from_arrays([pa.array(qid[i], pa.int64()), pa.array(cid[j], pa.int64()),
                                                  pa.array(near, pa.float64()), pa.array(real, pa.float64())],
                                                 names=["_qid", "_cid", "_near", "distance"])
    return run


_FOUND = "_qid bigint, _cid bigint, _near double, distance double"


class _Rings:
    """The ring table (at most MAX_PIVOTS x RINGS rows), in ring order."""

    def __init__(self, rows, p: int):
        rows = sorted(rows, key=lambda r: r["_ring"])
        self.id = np.array([r["_ring"] for r in rows], dtype=np.int64)
        self.cell = self.id // RINGS
        self.count, self.low, self.high = (np.array([r[c] for r in rows], dtype=t) for c, t in
                                           (("_n", np.int64), ("_low", np.float64), ("_high", np.float64)))
        self.start = np.searchsorted(self.cell, np.arange(p + 1))

    def first(self, d: np.ndarray, kk: int) -> np.ndarray:
        """Which rings each query meets in the first phase (rows x rings)."""
        out = np.zeros((len(d), len(self.id)), dtype=bool)
        own = d.argmin(1)
        for c in np.unique(own):
            mine, part = np.flatnonzero(own == c), slice(self.start[c], self.start[c + 1])
            if self.count[part].sum() >= kk:
                dc = d[mine, c][:, None]
                gap = np.maximum(0, np.maximum(self.low[part] - dc, dc - self.high[part]))
                order = np.argsort(gap, axis=1, kind="stable")
                held = np.cumsum(self.count[part][order], axis=1)
                take = held - self.count[part][order] < kk
                r, j = np.nonzero(take)
                out[mine[r], part.start + order[r, j]] = True
                continue
            for i in mine:              # a small cell: whole cells by pivot distance
                held = 0
                for near in np.argsort(d[i], kind="stable"):
                    cell = slice(self.start[near], self.start[near + 1])
                    out[i, cell] = True
                    held += self.count[cell].sum()
                    if held >= kk:
                        break
        return out

    def within(self, d: np.ndarray, theta: np.ndarray, met: np.ndarray, most: int | None = None) -> np.ndarray:
        """Rings that can hold a class within theta and are not met (rows x rings); of many
        the ``most`` with the least bounds."""
        dc = d[:, self.cell]
        least = np.maximum(np.maximum(dc - self.high, self.low - dc), (dc - d.min(1)[:, None]) / 2)
        out = (least <= theta[:, None]) & ~met
        if most is not None and most < out.shape[1]:
            least[~out] = np.inf
            far = np.argsort(least, axis=1, kind="stable")[:, most:]
            np.put_along_axis(out, far, False, axis=1)
        return out

    def listed(self, ids: pa.Array) -> np.ndarray:
        """Lists of ring ids as a mask (rows x rings)."""
        out = np.zeros((len(ids), len(self.id)), dtype=bool)
        row = np.repeat(np.arange(len(ids)), np.diff(ids.offsets.to_numpy()))
        out[row, np.searchsorted(self.id, ids.flatten().to_numpy())] = True
        return out


def _ring_ids(rings: _Rings, mask: np.ndarray) -> pa.Array:
    row, at = np.nonzero(mask)
    return _ragged(row, rings.id[at].astype(np.int32), len(mask), pa.int32())


def _met(asked: DataFrame, blocks: DataFrame, parts: Column) -> DataFrame:
    """Block pairs ``q, t`` (and their key) of queries (``_bid, _v, _theta,
    _rings``) and ring blocks."""
    spark = asked.sparkSession
    flat = asked.select("_bid", "_v", "_theta", F.explode("_rings").alias("_ring"))
    # How many queries ask for a ring (at most as many rows as there are rings).
    wanted = {r[0]: r[1] for r in flat.groupBy("_ring").count().collect()}
    if not wanted:
        return spark.createDataFrame([], "_ring int, _part int, _salt int, "
                                         "q array<struct<id:bigint,v:array<double>,theta:double>>, "
                                         "t array<struct<id:bigint,v:array<double>>>")
    top = max(wanted) + 1
    n_asked = F.element_at(json_lit([wanted.get(c, 0) for c in range(top)], "array<bigint>"), F.col("_ring") + 1)
    packed = _in_blocks(flat, ["_ring"], F.struct(F.col("_bid").alias("id"), F.col("_v").alias("v"),
                                                  F.col("_theta").alias("theta")), "q", n_asked, keep_part=True)
    salts = F.ceil(F.ceil(n_asked / BLOCK) / SALT_BLOCKS).cast("int")
    queries = packed.select("_ring", "q", F.pmod("_part", salts).cast("int").alias("_salt"),
                            F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"))
    trains = blocks.where(F.col("_ring") < top).where(n_asked > 0) \
        .select("_ring", F.col("_part").cast("int").alias("_part"), "t", F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt"))
    return queries.join(trains, ["_ring", "_part", "_salt"])


def _in_blocks(df: DataFrame, by: list[str], entry, name: str, size_of: Column, keep_part: bool = False) -> DataFrame:
    """Rows packed to blocks of about BLOCK per key, dealt by hash."""
    part = F.pmod(F.xxhash64("_bid"), F.ceil(size_of / BLOCK)).alias("_part")
    out = df.select(*by, part, entry.alias("_e")).groupBy(*by, "_part").agg(F.collect_list("_e").alias(name))
    return out if keep_part else out.drop("_part")


class Search:
    """What a search found: ``found`` has at most kk classes per query and pair
    of blocks (``_qid, _cid, distance``), ``classes`` the members of each class;
    ``phases`` the pairs of blocks that each phase compared."""

    def __init__(self, found: DataFrame, classes: DataFrame, phases: list[DataFrame]):
        self.found, self.classes, self.phases = found, classes, phases

    def compared(self) -> list[int]:
        """Vector pairs compared by each phase."""
        n = F.sum(F.size("q").cast("bigint") * F.size("t"))
        return [p.agg(n).first()[0] or 0 for p in self.phases]


def _classes(train: DataFrame, kk: int, tid: str, vec: str, label: str | None) -> DataFrame:
    member = F.struct(F.col(tid).cast("bigint").alias("tid"), *([F.col(label).alias("label")] if label else []))
    rows = train.select(F.col(vec).cast("array<double>").alias("_v"), F.col(tid).cast("bigint").alias("_tid"),
                        member.alias("_m"))
    # A row limit per vector before the lists are built: a hot vector stays small.
    w = Window.partitionBy("_v").orderBy("_tid")
    few = rows.withColumn("_j", F.row_number().over(w)).where(F.col("_j") <= kk)
    return cut_lineage(few.groupBy("_v").agg(F.min("_tid").alias("_bid"), F.sort_array(F.collect_list("_m")).alias("_members")))


def knn_search(query: DataFrame, train: DataFrame, k: int, metric: str = "euclidean",
               qid: str = "qid", tid: str = "tid", vec: str = "vec", label: str | None = None,
               exclude_self: bool = False, n_pivots: int | None = None, seed: int = 42) -> Search:
    """The two-phase search (see the module's docstring)."""
    metric = D.canonical(metric)
    if k < 1:
        raise ValueError("k must be >= 1")
    kk = k + 1 if exclude_self else k
    search = "manhattan" if metric == "manhattan" else "euclidean"
    classes = _classes(train, kk, tid, vec, label)
    size = classes.agg(F.count(F.lit(1)), F.sum(F.size("_members"))).first()
    n_classes, held = size[0], size[1] or 0
    if kk > held:
        raise ValueError(f"k={k} needs at least {kk} train rows, got {held}")
    # A cell holds about a block, so that a query is sent to few of them where none can be left out.
    p = min(n_pivots or min(math.isqrt(n_classes), -(-n_classes // BLOCK)), MAX_PIVOTS, n_classes) if n_classes > FEW else 1
    # bounded top-P by digest (partial top-k per partition, P rows reach the driver)
    prow = classes.orderBy(digest("_bid", seed, "pivot"), "_bid").select("_v").limit(p).collect()
    spark = train.sparkSession
    bc = spark.sparkContext.broadcast(_search_space(np.stack([np.asarray(r["_v"], dtype=np.float64) for r in prow]), metric))

    def assign(batches):
        for b in batches:
            d = _to_pivots(_search_space(_mat(b.column("_v")), metric), bc.value, search) if b.num_rows else np.zeros((0, p))
            cell = d.argmin(1) if b.num_rows else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("_bid"), b.column("_v"), pa.array(cell.astype(np.int32)), pa.array(d[np.arange(b.num_rows), cell])],
                names=["_bid", "_v", "_cell", "_r"])

    td = cut_lineage(classes.select("_bid", "_v").mapInArrow(assign, "_bid bigint, _v array<double>, _cell int, _r double"))
    # Ring borders: approximate radius quantiles of each cell (P rows).
    steps = [(i + 1) / RINGS for i in range(RINGS - 1)]
    cuts: list[list[float]] = [[] for _ in range(p)]
    for r in td.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_r", steps, 1000).alias("e")).collect():
        m = min(RINGS, -(-r["n"] // BLOCK))
        cuts[r["_cell"]] = [r["e"][i * RINGS // m - 1] for i in range(1, m)]
    borders = F.element_at(json_lit(cuts, "array<array<double>>"), F.col("_cell") + 1)
    ring = F.col("_cell") * RINGS + F.size(F.filter(borders, lambda e: e < F.col("_r")))
    td = td.select("_bid", "_v", "_r", ring.cast("int").alias("_ring"))
    ring_rows = td.groupBy("_ring").agg(F.count(F.lit(1)).alias("_n"), F.min("_r").alias("_low"), F.max("_r").alias("_high")).collect()
    rings = _Rings(ring_rows, p)
    rb = spark.sparkContext.broadcast(ring_rows)    # plain rows: a broadcast is not pickled by value, as functions are
    counts = np.zeros(p * RINGS, dtype=np.int64)
    counts[rings.id] = rings.count
    parts = F.ceil(F.element_at(json_lit(counts.tolist(), "array<bigint>"), F.col("_ring") + 1) / BLOCK).cast("int")
    blocks = cut_lineage(_in_blocks(td, ["_ring"], F.struct(F.col("_bid").alias("id"), F.col("_v").alias("v")), "t",
                                    parts * BLOCK, keep_part=True))

    def choose(later: bool, most: int | None = None):
        """Rings that a query meets: the first ones, or of those within theta that are not
        met (``_met``: listed beside the first ones) all or ``most``."""
        def run(batches):
            table = _Rings(rb.value, p)
            step = max(1, CHUNK_ELEMS // max(1, len(table.id)))
            for b in batches:
                for i in range(0, b.num_rows, step):
                    part = b.slice(i, step)
                    S = _search_space(_mat(part.column("_v")), metric)
                    d = _to_pivots(S, bc.value, search)
                    mask = table.first(d, kk) if n_classes > FEW else np.ones((len(d), len(table.id)), dtype=bool)
                    theta = part.column("_theta").to_numpy(zero_copy_only=False)
                    if later:
                        theta = theta * (1 + SLACK) + SLACK
                        mask = table.within(d, theta, mask | table.listed(part.column("_met")), most)
                    if metric == "cosine":      # zero queries are answered apart (exact top-k by id)
                        mask &= (S[:, -1] == 0)[:, None]
                    yield pa.RecordBatch.from_arrays([part.column("_bid"), part.column("_v"), pa.array(theta),
                                                      _ring_ids(table, mask)], names=["_bid", "_v", "_theta", "_rings"])
        return run

    out = "_bid bigint, _v array<double>, _theta double, _rings array<int>"
    q = query.select(F.col(qid).cast("bigint").alias("_bid"), F.col(vec).cast("array<double>").alias("_v"))
    asked = cut_lineage(q.withColumn("_theta", F.lit(float("inf"))).mapInArrow(choose(False), out))
    phases = [_met(asked, blocks, parts)]
    found = phases[0].mapInArrow(_nearest(metric, kk), _FOUND)
    best = Window.partitionBy("_qid").orderBy("_near", "_cid")

    def further(found: DataFrame, asked: DataFrame, met: Column, most: int | None):
        """The kk nearest found so far, and the queries with their bounds and the next rings."""
        found = cut_lineage(found.withColumn("_j", F.row_number().over(best)).where(F.col("_j") <= kk).drop("_j"))
        theta = found.groupBy("_qid").agg(F.max("_near").alias("_t"), F.count(F.lit(1)).alias("_c"))
        bounded = asked.join(theta, F.col("_bid") == F.col("_qid"), "left") \
            .select("_bid", "_v", F.when(F.col("_c") == kk, F.col("_t")).otherwise(F.lit(float("inf"))).alias("_theta"),
                    met.alias("_met"))
        return found, cut_lineage(bounded.mapInArrow(choose(True, most), out))

    if n_classes > FEW:
        # Of many rings a query meets the nearest ones first, so that the others are met under a tight bound.
        many = len(ring_rows) > 2 * NEAR_RINGS
        none = F.array().cast("array<int>")
        found, asked = further(found, asked, none, NEAR_RINGS if many else None)
        later = _met(asked, blocks, parts)
        found = found.unionByName(later.mapInArrow(_nearest(metric, kk), _FOUND))
        if many:
            found, asked = further(found, asked, F.col("_rings"), None)
            last = _met(asked, blocks, parts)
            found = found.unionByName(last.mapInArrow(_nearest(metric, kk), _FOUND))
            cols = ["_ring", "_part", "_salt", "q", "t"]
            later = later.select(cols).unionByName(last.select(cols))
        phases.append(later)
    found = found.select("_qid", "_cid", "distance")
    if metric == "cosine":
        # A zero query is at cosine distance exactly 1 from every train row
        # (guarded denominator), so its neighbours are the smallest train
        # ids: a bounded top-kk instead of a search.
        first = [r["_bid"] for r in classes.orderBy("_bid").select("_bid").limit(kk).collect()]
        zero = q.where(F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x) == 0)
        found = found.unionByName(zero.select(F.col("_bid").alias("_qid"), F.explode(F.lit(first)).alias("_cid"),
                                              F.lit(1.0).alias("distance")))
    return Search(found, classes, phases)


def knn_candidates(query: DataFrame, train: DataFrame, k: int, metric: str = "euclidean",
                   qid: str = "qid", tid: str = "tid", vec: str = "vec", label: str | None = None,
                   exclude_self: bool = False, n_pivots: int | None = None, seed: int = 42):
    """(candidates, classes) of the exact search: at most k classes per query
    and pair of blocks (``_qid, _cid, distance``), and the classes' members."""
    s = knn_search(query, train, k, metric, qid, tid, vec, label, exclude_self, n_pivots, seed)
    return s.found, s.classes


def _ranked(found: DataFrame, classes: DataFrame, k: int, kk: int, qid: str, tid: str, label: str | None,
            exclude_self: bool) -> DataFrame:
    best = Window.partitionBy("_qid").orderBy("distance", "_cid")
    found = found.withColumn("_j", F.row_number().over(best)).where(F.col("_j") <= kk).drop("_j")
    rows = found.join(classes.select(F.col("_bid").alias("_cid"), "_members"), "_cid") \
        .select("_qid", "distance", F.explode("_members").alias("_m")).select("_qid", "distance", "_m.*")
    if exclude_self:
        rows = rows.where(F.col("_qid") != F.col("tid"))
    wr = Window.partitionBy("_qid").orderBy("distance", "tid")
    out = rows.withColumn("rank", F.row_number().over(wr)).where(F.col("rank") <= k)
    cols = [F.col("_qid").alias(qid), "rank", F.col("tid").alias(tid if tid != qid else "neighbor"), "distance"]
    if label:
        cols.append(F.col("label").alias(label))
    return out.select(*cols)


def knn_join(query: DataFrame, train: DataFrame, k: int, metric: str = "euclidean",
             qid: str = "qid", tid: str = "tid", vec: str = "vec", label: str | None = None,
             exclude_self: bool = False, n_pivots: int | None = None, seed: int = 42) -> DataFrame:
    """Exact kNN: (qid, rank 1..k, tid, distance[, label]).

    ``exclude_self``: query and train are the same rows (same ids); a row is
    not its own neighbour.
    """
    found, classes = knn_candidates(query, train, k, metric, qid, tid, vec, label, exclude_self, n_pivots, seed)
    return _ranked(found, classes, k, k + 1 if exclude_self else k, qid, tid, label, exclude_self)


# ------------------------------------------------------------ approximate branch
class Approximate:
    """Rows of an approximate join with the audited recall, the bucket length
    used (None: hashing did not reach the recall and all queries were joined
    exactly) and the DataFrame of query ids that were completed exactly."""

    def __init__(self, rows: DataFrame, recall: float, bucket_length: float | None, completed: DataFrame):
        self.rows, self.recall, self.bucket_length, self.completed = rows, recall, bucket_length, completed


AUDITED = 256                 # queries whose exact neighbours are known, at most
LSH_TABLES = 6
WIDENINGS = 10


def _shared_buckets(asked: DataFrame, points: DataFrame) -> DataFrame:
    """Block pairs ``q, t`` of the rows (``_bid, _v, _theta, hashes``) that share a bucket
    of a table: block joins within buckets, where a join of rows would make every pair."""
    def flat(df: DataFrame) -> DataFrame:
        return df.select("_bid", "_v", "_theta", F.posexplode("hashes").alias("_table", "_h")) \
            .withColumn("_h", F.element_at(vector_to_array("_h"), 1))

    by = ["_table", "_h"]
    queries, trains = flat(asked), flat(points)
    n_asked = queries.groupBy(by).agg(F.count(F.lit(1)).alias("_asked"))
    sizes = cut_lineage(trains.join(n_asked.select(by), by, "left_semi").groupBy(by).agg(F.count(F.lit(1)).alias("_held"))
                        .join(n_asked, by).select(*by, F.ceil(F.col("_held") / BLOCK).cast("int").alias("_parts"),
                                                  F.ceil(F.col("_asked") / BLOCK).alias("_blocks")))
    entry = F.struct(F.col("_bid").alias("id"), F.col("_v").alias("v"))
    packed = _in_blocks(queries.join(sizes, by), [*by, "_parts", "_blocks"], entry.withField("theta", F.col("_theta")), "q",
                        F.col("_blocks") * BLOCK, keep_part=True)
    salts = F.ceil(F.col("_blocks") / SALT_BLOCKS).cast("int")
    q = packed.select(*by, "q", F.pmod("_part", salts).cast("int").alias("_salt"),
                      F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
    t = _in_blocks(trains.join(sizes, by), [*by, "_parts", "_blocks"], entry, "t", F.col("_parts") * BLOCK, keep_part=True) \
        .select(*by, F.col("_part").cast("int").alias("_part"), "t", F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt"))
    return q.join(t, [*by, "_part", "_salt"])


def knn_join_approx(query: DataFrame, train: DataFrame, k: int, metric: str = "euclidean", qid: str = "qid",
                    tid: str = "tid", vec: str = "vec", label: str | None = None, recall: float = 0.95,
                    tables: int = LSH_TABLES, seed: int = 42) -> Approximate:
    """J1, approximate: random-projection hashing (euclidean, and cosine in the
    unit space), for query sets that are too large for the exact join.

    A bounded sample of queries (by digest) is joined exactly; its k-th distances
    set the similarity threshold (their largest) and the first bucket length (their median), and
    its neighbours measure the recall. Rows that share a bucket are met as pairs of
    blocks. Buckets are doubled until the audit reaches ``recall``. Queries for which hashing finds fewer than k rows are
    joined exactly, so every query has k neighbours; ranks and ties are those
    of ``knn_join`` among the rows found.
    """
    metric = D.canonical(metric)
    if metric == "manhattan":
        raise ValueError("no hashing family for manhattan: use knn_join")
    if not 0 < recall <= 1:
        raise ValueError("recall must be in (0, 1]")
    query = cut_lineage(query.select(F.col(qid).cast("bigint").alias("qid"), F.col(vec).cast("array<double>").alias("vec")))
    train = cut_lineage(train.select(F.col(tid).cast("bigint").alias("tid"), F.col(vec).cast("array<double>").alias("vec"),
                                     *([F.col(label).alias("label")] if label else [])))
    named = "label" if label else None
    sample = cut_lineage(query.orderBy(digest("qid", seed, "audit"), "qid").limit(AUDITED))
    exact = cut_lineage(knn_join(sample, train, k, metric, label=named, seed=seed))
    classes = _classes(train, k, "tid", "vec", named)

    def space(df, id_col):
        v = F.col("_v")
        if metric == "cosine":          # a zero vector is at 1 from everything: exact join
            norm = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x))
            df = df.withColumn("_n", norm).where(F.col("_n") > 0)
            v = F.transform("_v", lambda x: x / F.col("_n"))
        return df.select(F.col(id_col).alias("_bid"), v.alias("_v"), F.lit(threshold).alias("_theta"),
                         array_to_vector(v).alias("features"))

    last = exact.where(F.col("rank") == k).agg(F.max("distance").alias("most"), F.median("distance").alias("half")).first()

    def near(d):        # cosine distance c lies at sqrt(2 c) in the unit space
        return math.sqrt(2 * max(d, 0.0)) if metric == "cosine" else d

    def hashed(some: DataFrame, length: float) -> DataFrame:
        lsh = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=length,
                                          numHashTables=tables, seed=seed).fit(points)
        pairs = _shared_buckets(lsh.transform(some), lsh.transform(points))
        d = F.col("_near") * F.col("_near") / 2 if metric == "cosine" else F.col("_near")
        found = pairs.mapInArrow(_nearest("euclidean", k), _FOUND) \
            .select("_qid", "_cid", d.alias("distance")).distinct()       # met in several tables
        return _ranked(found, classes, k, k, "qid", "tid", named, False)

    threshold = near(last["most"] or 0.0) * (1 + 1e-6) + SLACK
    length, wanted = max(near(last["half"] or 0.0), threshold / 1024), exact.count()
    points = cut_lineage(space(classes, "_bid"))
    asked = space(query.withColumnRenamed("vec", "_v"), "qid")
    audit = cut_lineage(space(sample.withColumnRenamed("vec", "_v"), "qid"))
    for _ in range(WIDENINGS if wanted else 0):
        hit = hashed(audit, length).join(exact, ["qid", "tid"], "left_semi").count()
        if hit >= recall * wanted:
            rows = cut_lineage(hashed(asked, length))
            full = rows.groupBy("qid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == k).select("qid")
            short = cut_lineage(query.join(full, "qid", "left_anti"))
            if not short.isEmpty():
                rows = rows.join(short.select("qid"), "qid", "left_anti") \
                    .unionByName(knn_join(short, train, k, metric, label=named, seed=seed))
            return Approximate(_renamed(rows, qid, tid, label), hit / wanted, length, short.select(F.col("qid").alias(qid)))
        length *= 2
    rows = knn_join(query, train, k, metric, label=named, seed=seed)
    return Approximate(_renamed(rows, qid, tid, label), 1.0, None, query.select(F.col("qid").alias(qid)))


def _renamed(rows: DataFrame, qid: str, tid: str, label: str | None) -> DataFrame:
    cols = [F.col("qid").alias(qid), "rank", F.col("tid").alias(tid if tid != qid else "neighbor"), "distance"]
    return rows.select(*cols, *([F.col("label").alias(label)] if label else []))


# ------------------------------------------------------------ classifiers
def _weights(nn: DataFrame, weights: str, weight_mode: str, qid: str) -> DataFrame:
    if weights == "uniform":
        return nn.withColumn("_w", F.lit(1.0))
    if weights != "distance":
        raise ValueError("weights must be 'uniform' or 'distance'")
    if weight_mode == "eps":          # hand-written: 1 / (d + guard)
        return nn.withColumn("_w", 1.0 / (F.col("distance") + F.lit(WEIGHT_GUARD)))
    if weight_mode == "exact_match":  # library: exact matches take all the weight
        hit = F.max((F.col("distance") == 0).cast("int")).over(Window.partitionBy(qid))
        return nn.withColumn("_w", F.when(hit == 1, (F.col("distance") == 0).cast("double"))
                             .otherwise(1.0 / F.col("distance")))
    raise ValueError("weight_mode must be 'eps' or 'exact_match'")


def knn_votes(nn: DataFrame, weights: str = "uniform", weight_mode: str = "eps",
              qid: str = "qid", label: str = "label") -> DataFrame:
    """Per (query, class): summed neighbour weight."""
    return (_weights(nn, weights, weight_mode, qid).groupBy(qid, label)
            .agg(F.sum("_w").alias("vote")))


def knn_predict(nn: DataFrame, weights: str = "uniform", weight_mode: str = "eps",
                qid: str = "qid", label: str = "label") -> DataFrame:
    """M8/M9: class with the largest vote; a tie goes to the smaller class."""
    v = knn_votes(nn, weights, weight_mode, qid, label)
    most = v.groupBy(qid).agg(F.max("vote").alias("_most"))
    return v.join(most, qid).where(F.col("vote") == F.col("_most")) \
        .groupBy(qid).agg(F.min(label).alias("prediction"))


def knn_proba(nn: DataFrame, classes: list, weights: str = "uniform", weight_mode: str = "exact_match",
              qid: str = "qid", label: str = "label") -> DataFrame:
    """Vote share of every training class (zeros kept)."""
    v = knn_votes(nn, weights, weight_mode, qid, label)
    per_q = v.groupBy(qid).agg(F.map_from_entries(F.collect_list(F.struct(label, "vote"))).alias("_m"),
                               F.sum("vote").alias("_t"))
    cls = F.array(*[F.lit(c) for c in classes])
    return (per_q.select(qid, "_m", "_t", F.explode(cls).alias(label))
            .select(qid, label, (F.coalesce(F.try_element_at("_m", F.col(label)), F.lit(0.0)) / F.col("_t"))
                    .alias("proba")))
