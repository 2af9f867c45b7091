"""M5 by aggregations against a plain round-by-round search."""

import numpy as np
import pytest

from txrisk.operators import boosting as bo

NAMES = ["a", "b"]


def _tree(x, g, h, depth, rate, lam, least, total, node=1, level=0):
    """{node: (feature, threshold, value)} by trying every cut."""
    best = None
    if level < depth:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for lo, hi in zip(values, values[1:]):
                left = x[:, f] < hi
                hl, hr = h[left].sum(), h[~left].sum()
                if min(hl, hr) < least:
                    continue
                gain = g[left].sum() ** 2 / (hl + lam) + g[~left].sum() ** 2 / (hr + lam) - g.sum() ** 2 / (h.sum() + lam)
                gain = round(gain / total, bo.PLACES)
                if gain > 0 and (best is None or gain > best[0]):
                    best = gain, f, (lo + hi) / 2
    if best is None:
        return {node: (None, None, -rate * g.sum() / (h.sum() + lam))}
    left = x[:, best[1]] <= best[2]
    out = {node: (NAMES[best[1]], best[2], None)}
    for side, child in ((left, 2 * node), (~left, 2 * node + 1)):
        out |= _tree(x[side], g[side], h[side], depth, rate, lam, least, total, child, level + 1)
    return out


def _leaf(tree, row):
    at = 1
    while tree[at][0]:
        at = 2 * at + (row[NAMES.index(tree[at][0])] > tree[at][1])
    return tree[at][2]


def _data(n=150, seed=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n).round(1), rng.integers(0, 6, n)], 1)
    return x, ((x[:, 0] * (x[:, 1] - 2) + 0.3 * rng.normal(size=n)) > 0.5).astype(int)


def _frame(spark, x, y):
    return spark.createDataFrame([(i, *map(float, v), int(c)) for i, (v, c) in enumerate(zip(x, y))],
                                 "row_key long, a double, b double, label int")


def test_equals_a_plain_search(spark):
    x, y = _data()
    w = np.where(y == 1, 2.5, 1.0)
    df = _frame(spark, x, y)
    nodes = bo.fit_newton_boosting(df.repartition(5), NAMES, rounds=3, depth=2, rate=0.3, pos_weight=2.5, lam=0.5, min_child=2.0)
    got = {(r.tree, r.node): (r.feature, r.threshold, r.value) for r in nodes.collect()}
    margin, want = np.zeros(len(y)), {}
    for t in range(3):
        p = 1 / (1 + np.exp(-margin))
        tree = _tree(x, w * (p - y), w * p * (1 - p), 2, 0.3, 0.5, 2.0, w.sum())
        want |= {(t, k): v for k, v in tree.items()}
        margin += [_leaf(tree, r) for r in x]
    assert got.keys() == want.keys()
    for k, (f, cut, value) in want.items():
        assert got[k][0] == f
        assert (abs(got[k][1] - cut) < 1e-12 and got[k][2] is None) if f else abs(got[k][2] - value) < 1e-7
    scored = {r.row_key: (r.score, r.prediction) for r in bo.predict_newton_boosting(nodes, df, NAMES).collect()}
    assert np.allclose([scored[i][0] for i in range(len(y))], 1 / (1 + np.exp(-margin)), atol=1e-7)
    assert all(p == (s > 0.5) for s, p in scored.values())


def test_partitioning_does_not_matter(spark):
    df = _frame(spark, *_data(seed=8))
    one, many = (sorted(map(tuple, bo.fit_newton_boosting(d, NAMES, rounds=2, depth=2).collect()), key=lambda r: r[:2])
                 for d in (df.coalesce(1), df.repartition(13)))
    assert one == many


def test_edges(spark):
    df = spark.createDataFrame([(1, 1.0, None, 1), (2, 1.0, 3.0, 1), (3, 1.0, 3.0, 0), (4, 2.0, 3.0, None)],
                               "row_key long, a double, b double, label int")
    nodes = bo.fit_newton_boosting(df, NAMES, rounds=2, depth=3)        # two equal rows: nothing to split
    assert [(r.tree, r.node, r.feature) for r in nodes.collect()] == [(0, 1, None), (1, 1, None)]
    out = bo.predict_newton_boosting(nodes, df.selectExpr("*", "'x' AS score"), NAMES).orderBy("row_key").collect()
    assert [r.score for r in out] == [None, 0.5, 0.5, 0.5] and out[0].prediction is None
    assert bo.fit_newton_boosting(df.limit(0), NAMES).count() == 0
    with pytest.raises(ValueError):
        bo.predict_newton_boosting(nodes.limit(0), df, NAMES)
    for wrong in ({"rounds": 0}, {"depth": 99}, {"rate": 0.0}, {"pos_weight": 0.0}):
        with pytest.raises(ValueError):
            bo.fit_newton_boosting(df, NAMES, **wrong)
    with pytest.raises(ValueError):
        bo.fit_newton_boosting(df.na.fill(2, ["label"]), NAMES)


def test_scale_leaves_room():
    for total in (1.0, 1e3, 1e9, 1e13, 1e17):
        s = bo.scale_for(total)
        assert total * s <= 2.0 ** 62 and (s == 2.0 ** 30 or total * s > 2.0 ** 60)
