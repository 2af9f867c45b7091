"""M2 with exact splits against a plain recursive search."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from txrisk.operators import exact_tree as et

NAMES = ["a", "b", "c"]


def _gini(p, n):
    return 0.0 if p + n == 0 else 2 * (p / (p + n)) * (1 - p / (p + n))


def _by_hand(x, y, depth, w, min_leaf, node=1, level=0, tries=lambda node: range(3)):
    """{node: (feature, threshold, n, positives, gain)} by trying every cut."""
    p, n = y.sum() * w[1], (1 - y).sum() * w[0]
    best = None
    if level < depth:
        for f in sorted(tries(node)):
            values = np.unique(x[:, f])
            for lo, hi in zip(values, values[1:]):
                left = x[:, f] < hi
                if min(left.sum(), (~left).sum()) < min_leaf:
                    continue
                lp, ln = y[left].sum() * w[1], (1 - y[left]).sum() * w[0]
                gain = round(_gini(p, n) - (lp + ln) / (p + n) * _gini(lp, ln)
                             - (p + n - lp - ln) / (p + n) * _gini(p - lp, n - ln), et.PLACES)
                if gain > 0 and (best is None or gain > best[0]):
                    best = gain, f, (lo + hi) / 2
    out = {node: (best and NAMES[best[1]], best and best[2], len(y), int(y.sum()), best and best[0])}
    if best:
        left = x[:, best[1]] <= best[2]
        out |= _by_hand(x[left], y[left], depth, w, min_leaf, 2 * node, level + 1, tries)
        out |= _by_hand(x[~left], y[~left], depth, w, min_leaf, 2 * node + 1, level + 1, tries)
    return out


def _frame(spark, x, y):
    return spark.createDataFrame([(*map(float, v), int(c)) for v, c in zip(x, y)], "a double, b double, c double, label int")


@pytest.mark.parametrize("seed,weights,min_leaf", [(0, (1.0, 1.0), 1), (1, (0.7, 3.1), 1), (2, (1.0, 1.0), 9)])
def test_equals_a_plain_search(spark, seed, weights, min_leaf):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=300).round(2), rng.integers(0, 5, 300), rng.normal(size=300)], 1)
    y = ((x[:, 0] + 0.4 * x[:, 1] + 0.3 * rng.normal(size=300)) > 0.8).astype(int)
    got = et.fit_exact_tree(_frame(spark, x, y).repartition(5), NAMES, depth=3, weights=weights, min_leaf=min_leaf)
    rows = {r.node: (r.feature, r.threshold, r.n, r.positives, r.gain) for r in got.collect()}
    want = _by_hand(x, y, 3, weights, min_leaf)
    assert rows.keys() == want.keys()
    for k, w in want.items():
        assert rows[k][0] == w[0] and rows[k][2:4] == w[2:4]
        assert w[1] is None or (abs(rows[k][1] - w[1]) < 1e-12 and abs(rows[k][4] - w[4]) < 1e-8)


def test_deep_tree_predicts_its_training_rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(80, 3))
    y = rng.integers(0, 2, 80)
    df = _frame(spark, x, y)
    nodes = et.fit_exact_tree(df, NAMES, depth=et.MOST_DEPTH)
    out = et.predict_exact_tree(nodes, df, NAMES)
    assert out.where(F.col("prediction") != F.col("label")).count() == 0
    assert out.where(~F.col("score").isin(0.0, 1.0)).count() == 0


def test_edges(spark):
    df = spark.createDataFrame([(1.0, 2.0, None, 1), (1.0, 2.0, 3.0, 1), (1.0, 2.0, 3.0, 0), (2.0, 2.0, 3.0, None)],
                               "a double, b double, c double, label int")
    one = et.fit_exact_tree(df, NAMES, depth=4).collect()           # two equal rows: nothing to split
    assert [(r.node, r.feature, r.n, r.positives) for r in one] == [(1, None, 2, 1)]
    assert et.fit_exact_tree(df.limit(0), NAMES).count() == 0
    pure = et.fit_exact_tree(df.where("label = 1"), NAMES).collect()
    assert len(pure) == 1 and pure[0].impurity == 0
    with pytest.raises(ValueError):
        et.fit_exact_tree(df, NAMES, depth=99)


def _sampled(keys, tree, seed):
    """How often each key stands in the tree: inverse of the Poisson distribution, step by step."""
    out = []
    for k in keys:
        u = int(hashlib.md5(f"{k}:{seed}:tree{tree}".encode()).hexdigest()[:8], 16) / 2**32
        n, p = 0, math.exp(-1)
        while u >= p and n < 40:
            u, n = u - p, n + 1
            p /= n
        out.append(n)
    return np.array(out)


def test_forest_equals_plain_searches(spark):
    rng = np.random.default_rng(7)
    x = np.stack([rng.normal(size=200).round(1), rng.integers(0, 4, 200), rng.normal(size=200)], 1)
    y = ((x[:, 0] - 0.5 * x[:, 1] + 0.5 * rng.normal(size=200)) > 0).astype(int)
    df = spark.createDataFrame([(i, *map(float, v), int(c)) for i, (v, c) in enumerate(zip(x, y))],
                               "row_key long, a double, b double, c double, label int").repartition(4)
    w = (0.8, 1.4)
    nodes = et.fit_exact_forest(df, NAMES, trees=3, depth=2, weights=w, min_leaf=2, per_split=2, seed=9)
    got = {r.node: (r.feature, r.threshold, r.n, r.positives, r.gain) for r in nodes.collect()}

    def tries(node):
        return sorted(range(3), key=lambda f: hashlib.md5(f"{node}:{f}:9".encode()).hexdigest())[:2]

    want, scores, shares = {}, np.zeros(200), np.zeros(3)
    for t in range(3):
        times = _sampled(range(200), t, 9)
        assert 0.7 < times.mean() < 1.3 and times.max() > 2
        tree = _by_hand(np.repeat(x, times, 0), np.repeat(y, times), 2, w, 2, 4 + t, 0, tries)
        want |= tree
        own = np.zeros(3)
        for f, _, n, p, g in tree.values():
            if f:
                own[NAMES.index(f)] += g * (p * w[1] + (n - p) * w[0])
        shares += own / own.sum()
        for i in range(200):
            at = 4 + t
            while tree[at][0]:
                at = 2 * at + (x[i, NAMES.index(tree[at][0])] > tree[at][1])
            n, p = tree[at][2:4]
            scores[i] += p * w[1] / (p * w[1] + (n - p) * w[0]) / 3
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k][0] == v[0] and got[k][2:4] == v[2:4]
        assert v[1] is None or (abs(got[k][1] - v[1]) < 1e-12 and abs(got[k][4] - v[4]) < 1e-8)
    out = {r.row_key: r.score for r in et.predict_exact_tree(nodes, df, NAMES, w).collect()}
    assert np.allclose([out[i] for i in range(200)], scores, atol=1e-12)
    imp = {r.feature: r.importance for r in et.exact_importances(nodes, NAMES, weights=w).collect()}
    assert np.allclose([imp[c] for c in NAMES], shares / shares.sum(), atol=1e-6)


def test_forest_edges(spark):
    df = spark.createDataFrame([(1, 1.0, None, 1), (2, 1.0, 3.0, 1), (3, 2.0, 3.0, 0), (4, 2.0, 3.0, None)],
                               "row_key long, a double, b double, label int")
    nodes = et.fit_exact_forest(df, ["a", "b"], trees=8, depth=1)
    assert nodes.where("depth = 0").count() <= 8 and nodes.where("n > 8").count() == 0
    assert et.predict_exact_tree(nodes, df, ["a", "b"]).where("score IS NULL").count() == 0
    none = et.fit_exact_forest(df.limit(0), ["a", "b"])
    assert none.count() == 0
    assert [r.importance for r in et.exact_importances(none, ["a", "b"]).collect()] == [0.0, 0.0]
    for wrong in ({"trees": 0}, {"per_split": 3}, {"depth": 99}):
        with pytest.raises(ValueError):
            et.fit_exact_forest(df, ["a", "b"], **wrong)
    with pytest.raises(ValueError):
        et.predict_exact_tree(none, df, ["a", "b"])


def test_a_forest_writes_its_rows_once(spark, monkeypatch):
    """One written row a training row, not one a draw, tree and level."""
    written, write = [], et.cut_lineage
    monkeypatch.setattr(et, "cut_lineage", lambda df: written.append(write(df)) or written[-1])
    df = spark.range(400).select(F.col("id").alias("row_key"), (F.col("id") % 37).cast("double").alias("a"),
                                 (F.col("id") % 11).cast("double").alias("b"), (F.col("id") % 37 > 20).cast("int").alias("label"))
    nodes = et.fit_exact_forest(df, ["a", "b"], trees=4, depth=2)
    assert nodes.where("depth = 2").count() > 0
    assert [w.count() for w in written] == [400]
