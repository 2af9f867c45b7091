"""The two-phase search and the approximate branch."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from txrisk.operators import knn as kn
from txrisk.plans.queries import QUERIES, _emb_split


def _frame(spark, x, first=0):
    return spark.createDataFrame([(first + i, [float(a) for a in v]) for i, v in enumerate(x)], "tid long, vec array<double>")


def _queries(df):
    return df.withColumnRenamed("tid", "qid")


def _clusters(n, seed=0, centres=40, d=6):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(centres, d))[rng.integers(0, centres, n)] * 8 + rng.normal(size=(n, d))


def _brute(q, t, k, metric):
    if metric == "manhattan":
        d = np.abs(q[:, None] - t[None]).sum(-1)
    elif metric == "euclidean":
        d = np.sqrt(((q[:, None] - t[None]) ** 2).sum(-1))
    else:
        nq, nt = np.linalg.norm(q, axis=1), np.linalg.norm(t, axis=1)
        d = 1 - np.divide(q @ t.T, np.outer(nq, nt), out=np.zeros((len(q), len(t))), where=np.outer(nq, nt) > 0)
    return np.sort(d, axis=1)[:, :k]


def _distances(rows, k):
    out = {}
    for r in rows.collect():
        out.setdefault(r.qid, {})[r["rank"]] = r.distance
    return {q: [v[j] for j in range(1, k + 1)] for q, v in out.items()}


@pytest.fixture
def two_phases(monkeypatch):
    monkeypatch.setattr(kn, "FEW", 0)
    monkeypatch.setattr(kn, "BLOCK", 40)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "cosine"])
def test_two_phases_equal_brute_force(spark, two_phases, metric):
    x = _clusters(900, 1)
    x[10] = 0                               # a zero vector
    x[20:30] = x[20]                        # equal vectors
    got = _distances(kn.knn_join(_queries(_frame(spark, x[:150])), _frame(spark, x), 4, metric, n_pivots=9), 4)
    assert len(got) == 150
    assert np.allclose([got[i] for i in range(150)], _brute(x[:150], x, 4, metric), atol=1e-9)


def test_most_block_pairs_are_never_met(spark, two_phases):
    x = _clusters(4000, 2)
    search = kn.knn_search(_queries(_frame(spark, x[:400])), _frame(spark, x), 5, n_pivots=60)
    assert search.found.count() >= 400 * 5
    first, second = search.compared()
    assert first + second < 0.2 * 400 * 4000
    # The first phase alone meets a few blocks per query.
    assert first < 400 * 6 * kn.BLOCK


def test_a_hot_ring_is_dealt_to_salts(spark, two_phases, monkeypatch):
    """All queries ask for one place: no key meets more than SALT_BLOCKS query blocks."""
    monkeypatch.setattr(kn, "SALT_BLOCKS", 2)
    rng = np.random.default_rng(3)
    t = _frame(spark, rng.normal(size=(300, 3)))
    q = _queries(_frame(spark, np.zeros((1000, 3)) + rng.normal(size=(1000, 3)) * 1e-3))
    search = kn.knn_search(q, t, 3, n_pivots=4)
    keys = search.phases[0].groupBy("_ring", "_part", "_salt").count().collect()
    assert max(r["count"] for r in keys) <= 2 and len({r["_salt"] for r in keys}) > 3
    assert search.found.select("_qid").distinct().count() == 1000
    got = _distances(kn.knn_join(q, t, 3, n_pivots=4), 3)
    x, y = np.array([r.vec for r in q.orderBy("qid").collect()]), np.array([r.vec for r in t.orderBy("tid").collect()])
    assert np.allclose([got[i] for i in range(1000)], _brute(x, y, 3, "euclidean"), atol=1e-9)


def test_fewer_classes_than_k(spark, two_phases):
    x = np.repeat(np.arange(3.0)[:, None], 4, axis=0)           # three distinct vectors, twelve rows
    got = _distances(kn.knn_join(_queries(_frame(spark, x)), _frame(spark, x), 7), 7)
    assert all(v == sorted(v) and v[:4] == [0.0] * 4 for v in got.values())


def test_empty_queries(spark, two_phases):
    x = _frame(spark, _clusters(100))
    assert kn.knn_join(_queries(x.limit(0)), x, 3).count() == 0


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_approximate_recall(spark, metric):
    x = _clusters(3000, 4)
    t, q = _frame(spark, x), _queries(_frame(spark, x[:500]))
    res = kn.knn_join_approx(q, t, 5, metric)
    assert res.bucket_length is not None and res.recall >= 0.95
    exact = kn.knn_join(q, t, 5, metric)
    assert res.rows.count() == 500 * 5
    assert exact.join(res.rows.select("qid", "tid"), ["qid", "tid"], "left_semi").count() >= 0.95 * 500 * 5


def test_approximate_completes_lonely_queries(spark):
    """Queries outside the hashed range still get k neighbours, exactly."""
    x = _clusters(600, 5)
    far = np.full((3, 6), 1e4) + np.arange(3)[:, None]
    q = _queries(_frame(spark, np.vstack([x[:300], far])))
    res = kn.knn_join_approx(q, _frame(spark, x), 4)
    got = _distances(res.rows, 4)
    assert len(got) == 303 and np.allclose([got[300 + i] for i in range(3)], _brute(far, x, 4, "euclidean"))


def test_approximate_query_recall(spark):
    q, t = _emb_split(spark, SF_CHECK)
    exact = kn.knn_join(q, t, 5)
    got = QUERIES["knn_approx"](spark, SF_CHECK)
    n = exact.count()
    assert got.count() == n
    assert exact.join(got.select("qid", "tid"), ["qid", "tid"], "left_semi").count() >= 0.95 * n


def test_approximate_argument_errors(spark):
    x = _frame(spark, _clusters(50))
    with pytest.raises(ValueError):
        kn.knn_join_approx(_queries(x), x, 3, "manhattan")
    with pytest.raises(ValueError):
        kn.knn_join_approx(_queries(x), x, 3, recall=0)


@pytest.mark.parametrize("search", ["euclidean", "manhattan"])
@pytest.mark.parametrize("kind", ["plain", "ties", "far", "odd", "huge", "tiny"])
def test_rough_order_loses_no_neighbour(search, kind):
    """The k nearest of a block pair, bit by bit those of all exact distances."""
    rng = np.random.default_rng(8)
    x, y, cid, kk = rng.normal(size=(60, 7)), rng.normal(size=(400, 7)), rng.permutation(400), 4
    x, y = {"plain": (x, y), "ties": (x.round(), y.round()), "far": (x * 1e-5 + 1e6, y * 1e-5 + 1e6), "odd": (x, y),
            "huge": (x * 1e200, y * 1e200), "tiny": (x * 1e-180, y * 1e-180)}[kind]
    if kind == "odd":
        x[0, 0], y[0, 0], y[1, 1] = np.inf, np.nan, -np.inf
    with np.errstate(all="ignore"):
        all_d = kn.block_distances(x, y, search)
        for theta in (np.full(60, np.inf), np.sort(all_d, axis=1)[:, 2]):
            i, j, d = kn._top(x, y, theta, cid, kk, search)
            for row in range(60):
                ok = np.flatnonzero(all_d[row] <= theta[row])
                best = ok[np.lexsort((cid[ok], all_d[row, ok]))[:kk]]
                assert j[i == row].tolist() == best.tolist() and d[i == row].tolist() == all_d[row, best].tolist()


def test_a_cell_holds_about_a_block(spark, two_phases):
    """A query that meets every cell is sent about as often as there are train blocks."""
    x = np.random.default_rng(9).normal(size=(900, 30))
    search = kn.knn_search(_queries(_frame(spark, x[:50])), _frame(spark, x), 3)
    sent = sum(p.groupBy("_ring", "_salt").agg(F.first(F.size("q")).alias("n")).agg(F.sum("n")).first()[0] or 0
               for p in search.phases)
    assert sent <= 50 * -(-900 // kn.BLOCK) * 1.6


def test_shared_buckets_are_met_as_blocks(spark, monkeypatch):
    """Rows of a common bucket become few pairs of blocks; no pair is lost or met twice in a table."""
    monkeypatch.setattr(kn, "BLOCK", 40)
    monkeypatch.setattr(kn, "SALT_BLOCKS", 2)
    from pyspark.ml.functions import array_to_vector

    def rows(n):
        return spark.range(n).select(F.col("id").alias("_bid"), F.array(F.col("id").cast("double")).alias("_v"),
                                     F.lit(1e9).alias("_theta"),
                                     F.array(array_to_vector(F.array(F.lit(0.0))),
                                             array_to_vector(F.array((F.col("id") % 7).cast("double")))).alias("hashes"))
    pairs = kn._shared_buckets(rows(200), rows(300)).collect()
    assert len(pairs) < 200 and max(len(p["t"]) for p in pairs) < 80
    met = [(p["_table"], q["id"], t["id"]) for p in pairs for q in p["q"] for t in p["t"]]
    wanted = {(0, q, t) for q in range(200) for t in range(300)} | {(1, q, t) for _, q, t in met if q % 7 == t % 7}
    assert len(met) == len(set(met)) and set(met) == wanted
    assert sum(1 for m in met if m[0] == 1) == sum(1 for q in range(200) for t in range(300) if q % 7 == t % 7)


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Two phases in a session whose workers can't import the package."""
    code = f"""
import os, sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from txrisk.operators import knn as kn
from txrisk.session import get_spark
spark = get_spark("local[2]", "away", 4)
kn.FEW, kn.BLOCK = 0, 40
rows = spark.range(200).selectExpr("id tid", "array(id * 1D, (id % 7) * 2D) vec")
print("found", kn.knn_join(rows.withColumnRenamed("tid", "qid"), rows, 2, n_pivots=3).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "found 400" in out.stdout, out.stderr[-2000:]


def test_later_rings_are_met_under_a_tight_bound(spark, two_phases):
    """Without pruning, the rows found grow far less than with the blocks that a query meets."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 16))
    search = kn.knn_search(_queries(_frame(spark, x[:100])), _frame(spark, x), 5, n_pivots=150)
    assert sum(search.compared()) > 0.5 * 100 * 6000        # nothing much can be left out
    assert search.found.count() < 100 * 5 * 8               # of some 150 blocks
    got = _distances(kn.knn_join(_queries(_frame(spark, x[:100])), _frame(spark, x), 5, n_pivots=150), 5)
    assert np.allclose([got[i] for i in range(100)], _brute(x[:100], x, 5, "euclidean"), atol=1e-9)


def _top_by_hand(x, y, theta, cid, k, search):
    d = kn.block_distances(x, y, search)
    return [(i, j) for i in range(len(x)) for j in [j for j in np.lexsort((cid, d[i])) if d[i, j] <= theta[i]][:k]]


def _odd_blocks(rng):
    plain = rng.normal(size=(300, 16))
    dense = np.vstack([rng.normal(size=(299, 16)) * 1e-3, np.full((1, 16), 1e5)])     # one far row: rough orders say nothing
    grid = rng.integers(0, 3, (300, 4)).astype(float)                                # many ties
    return [plain, dense, grid, plain + 1e6, plain * 1e25, plain * 1e-25, plain * 1e200, np.ones((300, 3))]


def _same_as_by_hand(search):
    rng = np.random.default_rng(9)
    for x in _odd_blocks(rng):
        q, t, cid = x[:140], x[140:], rng.permutation(160) * 3
        with np.errstate(over="ignore"):
            d = kn.block_distances(q, t, search)
            for theta in (np.full(140, np.inf), np.sort(d, axis=1)[:, 7], np.zeros(140)):
                i, j, dist = kn._top(q, t, theta, cid, 4, search)
                assert list(zip(i, j)) == _top_by_hand(q, t, theta, cid, 4, search)
                assert np.allclose(dist, d[i, j], rtol=1e-12, atol=0)


def test_single_precision_orders_leave_exact_results():
    x = np.random.default_rng(10).normal(size=(64, 8))
    near, shift, unit, error = kn._rough(x, x, "euclidean", False)
    order = near(slice(0, 64))
    assert order.dtype == np.float32 and kn._rough(x, x, "euclidean", True)[0](slice(0, 64)).dtype == np.float64
    off = np.abs(order * unit + shift[:, None] - kn.block_distances(x, x, "euclidean") ** 2)
    assert np.all(off <= error[:, None] * unit)
    _same_as_by_hand("euclidean")


def test_sums_of_16_bits_leave_exact_results():
    x = np.random.default_rng(11).normal(size=(64, 8))
    near, shift, unit, error = kn._rough(x, x, "manhattan", False)
    order = near(slice(0, 64))
    assert order.dtype == np.int16 and order.min() >= 0
    off = np.abs(order * unit + shift[:, None] - kn.block_distances(x, x, "manhattan"))
    assert np.all(off <= error[:, None] * unit)
    _same_as_by_hand("manhattan")
