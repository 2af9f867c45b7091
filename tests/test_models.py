"""Models against facts that do not come from the library itself."""

import time

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_CHECK, SF_SMALL
from txrisk.operators import ensemble as en
from txrisk.operators import features as fe
from txrisk.operators import models as mo
from txrisk.operators import sampling as sa
from txrisk.operators.smote import balance
from txrisk.plans import pipeline as pl
from txrisk.schema import FEATURE_COLS, LABEL
from txrisk.sources import transactions as src


@pytest.fixture(scope="module")
def feat(spark):
    tx = src.load_tx(spark, SF_SMALL)
    return fe.feature_table(tx, fe.fit_type_codes(tx))


@pytest.fixture(scope="module")
def scaled(feat):
    return pl.prepare(feat, scaled=True)


def _toy(spark, n=400, seed=0, classes=2):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (n, 3)).astype(float)
    y = ((x[:, 0] * 2 + x[:, 1] + rng.normal(0, 4, n)) > 16).astype(int)
    if classes == 3:
        y = y + (x[:, 2] > 8)
    rows = [(int(i), Vectors.dense(*v), int(c), 1.0 + (i % 3)) for i, (v, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["row_key", "features", "label", "weight"]), x, y


def _impurity(y, w, kind):
    p = np.array([w[y == c].sum() for c in np.unique(y)]) / w.sum()
    return 1 - (p ** 2).sum() if kind == "gini" else -(p * np.log2(p)).sum()


@pytest.mark.parametrize("kind,classes", [("gini", 2), ("entropy", 2), ("entropy", 3)])
def test_root_split_is_the_best_one(spark, kind, classes):
    df, x, y = _toy(spark, classes=classes)
    w = np.array([1.0 + (i % 3) for i in range(len(y))])
    best = (-1.0, None)
    for f in range(3):
        for cut in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= cut
            gain = _impurity(y, w, kind) - sum(w[s].sum() / w.sum() * _impurity(y[s], w[s], kind) for s in (left, ~left))
            best = max(best, (gain, f"f{f}", cut))
    model = mo.decision_tree(3, kind, classes == 2, "weight").fit(df)
    nodes = {r["id"]: r for r in mo.tree_nodes(model, ["f0", "f1", "f2"], 3).collect()}
    root = nodes[0]
    assert root["feature"] == best[1] and best[2] <= root["threshold"] < best[2] + 1
    for r in nodes.values():
        if r["leftChild"] >= 0 and r["depth"] < 3:
            assert {r["leftChild"], r["rightChild"]} <= nodes.keys()


def test_logistic_regression_is_at_its_optimum(scaled):
    train, _ = scaled
    n = float(train.count())
    m = mo.logistic_regression(n, pl.LR_ITERATIONS, "weight", tol=1e-8).fit(train)
    rows = train.select("features", "label", "weight").collect()
    x = np.array([r["features"].toArray() for r in rows])
    y, w = (np.array([r[c] for r in rows], float) for c in ("label", "weight"))
    beta = m.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ beta + m.intercept)))
    assert abs((w * (p - y)).sum()) < 1e-2 * n                        # no penalty on the intercept
    assert np.abs(x.T @ (w * (p - y)) + beta).max() < 1e-2 * n        # C = 1: gradient of loss + |beta|^2 / 2
    again = mo.predict_binary(m, train).select("prediction", "score").collect()
    assert np.allclose([r["score"] for r in again], p) and [r["prediction"] for r in again] == (p > 0.5).tolist()


def test_no_single_feature_gives_the_label_away(spark):
    tx = src.load_tx(spark, SF_CHECK)
    feat = fe.feature_table(tx, fe.fit_type_codes(tx))
    study = pl.Study(feat)
    row = study.row("tree").first()
    assert 0.6 < row["roc_auc"] < 1.0 and row["f1"] < 1.0
    train, _ = study.frames(False)
    assert feat.where("balance_diff_dest = 0").agg(F.avg(LABEL)).first()[0] < 0.9
    model = mo.decision_tree(pl.TREE_DEPTH, weight_col="weight").fit(train)
    assert model.depth > 2
    imp = mo.importances(model, FEATURE_COLS, 12).collect()
    assert sum(r["importance"] for r in imp) == pytest.approx(1) and imp[0]["importance"] < 0.99
    assert [r["importance"] for r in imp] == sorted((r["importance"] for r in imp), reverse=True)


def test_forest_trees_can_be_listed(spark):
    df, _, _ = _toy(spark)
    m = mo.random_forest(3, 4, max_features="log2", weight_col="weight").fit(df)
    for t in range(3):
        nodes = mo.tree_nodes(m, ["f0", "f1", "f2"], 4, t)
        assert nodes.where("depth = 0").count() == 1 and nodes.count() > 1
    three = mo.random_forest(3, 4, "entropy", binary=False).fit(_toy(spark, classes=3)[0])
    assert three.numClasses == 3


def test_boosting_presets(spark):
    df, x, y = _toy(spark, 200)
    m = mo.boosting(*pl.BOOSTING_FALLBACK[:2], pl.BOOSTING_FALLBACK[2]).fit(df)
    assert m.getNumTrees == pl.BOOSTING_FALLBACK[0]
    rows = mo.predict_binary(m, df).select("label", "prediction", "score").collect()
    assert np.mean([r["label"] == r["prediction"] for r in rows]) > 0.9 and all(0 <= r["score"] <= 1 for r in rows)
    assert (mo.boosting().getMaxIter(), mo.boosting().getMaxDepth()) == pl.BOOSTING[:2]


def test_depth_over_the_limit_is_an_error():
    assert mo.decision_tree(None).getMaxDepth() == 30
    with pytest.raises(ValueError):
        mo.decision_tree(31)


class _Memory:
    """A base 'model' that scores 1 for rows it was fitted on and 0 for others."""

    def __init__(self, keys=()):
        self.keys = list(keys)

    def fit(self, df):
        return _Memory(r[0] for r in df.select("row_key").collect())

    def transform(self, df):
        return df.withColumn("p1", F.col("row_key").isin(self.keys).cast("double"))


def test_out_of_fold_rows_are_unseen(spark):
    df, _, y = _toy(spark, 90)
    oof = en.out_of_fold(df, {"m": _Memory}, 3)
    assert oof.count() == 90 and oof.where("p_m <> 0").count() == 0
    sizes = {(r["fold"], r["label"]): r["count"] for r in oof.groupBy("fold", "label").count().collect()}
    for c in (0, 1):
        per = [sizes[f, c] for f in range(3)]
        assert sum(per) == int((y == c).sum()) and max(per) - min(per) <= 1


def test_soft_vote_tie_goes_to_class_zero(spark):
    df = spark.createDataFrame([(0.4, 0.6), (0.4, 0.7)], "p_a double, p_b double")
    assert [r["prediction"] for r in en.soft_vote(df, ["a", "b"]).collect()] == [0, 1]


def test_stacking_and_voting_rows(feat):
    study = pl.Study(feat)
    for row in (study.row("voting").first(), study.row("stacking").first()):
        assert all(0 <= row[c] <= 1 for c in ("accuracy", "precision", "recall", "f1", "roc_auc"))


def test_board_has_the_nine_models_and_comparison_filters_it():
    assert len(pl.Study.MODELS) == 9 and set(pl.Study.BALANCING) <= set(pl.Study.MODELS)


def test_balancing_comparison_rows(feat):
    board = pl.Study(feat).board(pl.Study.BALANCING)
    got = pl.balancing_comparison(board).collect()
    assert sorted(r["model"] for r in got) == sorted(pl.BALANCING_NAMES)
    ranks = pl.metric_ranking(board)
    assert ranks.where("rank = 1").count() == 5 and ranks.schema["rank"].dataType == T.IntegerType()


def test_balance_dispatch(feat):
    train = feat.select("row_key", "amount", "oldbalanceDest", LABEL)
    cols = ["amount", "oldbalanceDest"]
    n = sa.class_count_dict(train)
    assert sa.class_count_dict(balance(train, cols, "undersampling")) == {0: n[1] * 10, 1: n[1]}
    assert sa.class_count_dict(balance(train, cols, "SMOTE")) == {0: n[0], 1: int(0.1 * n[0])}
    with pytest.raises(ValueError):
        balance(train, cols, "ADASYN")


def test_the_board_fits_its_models_at_the_same_time(spark):
    from threading import Barrier

    both = Barrier(2, timeout=60)
    pred = spark.createDataFrame([(0, 0, 0.1), (1, 1, 0.9)], "label int, prediction int, score double")

    class Two(pl.Study):
        NAMES = {"a": "A", "b": "B"}

        def frames(self, scaled):
            return None

        def a(self):
            both.wait()
            return pred, 0.0

        b = a

    rows = Two(pred).board(("a", "b")).collect()
    assert [(r.model, r.f1) for r in rows] == [("A", 1.0), ("B", 1.0)]


def test_large_frames_are_dealt_over_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = pl._dealt(spark.range(0, pl.DEALT_FROM, 1, 1))
    sizes = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == cores and max(sizes) < 1.2 * pl.DEALT_FROM / cores
    assert rows.select("id").distinct().count() == pl.DEALT_FROM
    assert pl._dealt(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == 1


def test_fits_that_cannot_be_cached_together_run_by_themselves(spark, monkeypatch):
    from threading import Lock

    monkeypatch.setattr(pl, "cache_memory", lambda spark: 1000, raising=False)
    rows = spark.createDataFrame([(0, 0, 0.1), (1, 1, 0.9)], "label int, prediction int, score double")
    lock, running, seen = Lock(), set(), []

    class Small(pl.Study):
        def frames(self, scaled):
            self._frames[scaled] = (rows, rows)     # two train rows

        def _say(self, name):
            with lock:
                running.add(name)
                seen.append(frozenset(running))
            time.sleep(1)
            with lock:
                running.discard(name)
            return rows, 0.0

        def forest(self):
            return self._say("forest")

        def boosting(self):
            return self._say("boosting")

        def tree(self):
            return self._say("tree")

    board = Small(rows).board(("tree", "forest", "boosting")).collect()
    assert [r.model for r in board] == ["Decision Tree", "Gradient Boosting", "Random Forest"]
    assert {"forest"} in seen and not any("forest" in s and len(s) > 1 for s in seen)   # 2 x 550 bytes are too many
    assert {"boosting", "tree"} <= set().union(*seen)


def test_tasks_start_while_there_is_room():
    from threading import Barrier

    both = Barrier(2, timeout=60)
    tasks = {"a": both.wait, "b": both.wait, "large": lambda: "x"}
    done = pl.run_within(tasks, {"a": 5, "b": 5, "large": 100}, 10)
    assert sorted([done["a"], done["b"]]) == [0, 1] and done["large"] == "x"
    assert pl.run_within({}, {}, 1) == {}
    with pytest.raises(ZeroDivisionError):
        pl.run_within({"bad": lambda: 1 / 0, "next": lambda: 1}, {"bad": 9, "next": 9}, 10)


def test_cache_memory_is_the_storage_of_the_session(spark):
    from txrisk.session import cache_memory

    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    assert 0.3 * (heap - 300 * 2**20) < cache_memory(spark) < heap


def test_scaled_frames_come_from_the_unscaled_ones(feat, monkeypatch):
    want = [sorted(map(str, f.select("row_key", "label", "features").collect())) for f in pl.prepare(feat, scaled=True)]
    weights = dict(pl.prepare(feat, scaled=True)[0].select("row_key", "weight").collect())
    split, calls = sa.stratified_split, []
    monkeypatch.setattr(sa, "stratified_split", lambda *a, **k: calls.append(1) or split(*a, **k))
    study = pl.Study(feat)
    study.frames(False)
    train, test = study.frames(True)
    assert len(calls) == 1
    assert [sorted(map(str, f.select("row_key", "label", "features").collect())) for f in (train, test)] == want
    assert dict(train.select("row_key", "weight").collect()) == weights
