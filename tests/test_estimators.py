"""Own estimators and the fitted pipeline: facts, saving, loading, streams."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from txrisk.operators import estimators as es
from txrisk.operators import models as mo
from txrisk.plans import fitted as ft
from txrisk.plans import pipeline as pl
from txrisk.schema import KEY
from txrisk.sources import transactions as src
from txrisk.streaming.scoring import events_stream


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 300)
    x = rng.normal(size=(300, 4)) + y[:, None]
    x[:, 3] = 7.0                                   # constant
    df = spark.createDataFrame([(i, int(c), *map(float, v)) for i, (c, v) in enumerate(zip(y, x))],
                               "id long, label int, a double, b double, c double, d double")
    return mo.assemble(df, ["a", "b", "c", "d"]), x, y


def test_scaler_uses_the_population_std(points):
    df, x, _ = points
    model = es.PopulationScaler(inputCol="features", outputCol="z").fit(df)
    z = np.array([r.z.toArray() for r in model.transform(df).orderBy("id").collect()])
    std = x.std(axis=0)
    assert np.allclose(z, (x - x.mean(axis=0)) / np.where(std == 0, 1, std), atol=1e-12)


def test_naive_bayes_equals_a_dense_version(points):
    df, x, y = points
    out = es.ClosedFormNB().fit(df).transform(df).orderBy("id").collect()
    eps = 1e-9 * x.var(axis=0).max()
    logs = np.stack([np.log((y == c).mean()) - 0.5 * (np.log(2 * np.pi * (x[y == c].var(0) + eps))
                     + (x - x[y == c].mean(0)) ** 2 / (x[y == c].var(0) + eps)).sum(1) for c in range(3)], 1)
    p = np.exp(logs - logs.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    assert np.allclose([r.probability.toArray() for r in out], p, atol=1e-9)
    assert [r.prediction for r in out] == logs.argmax(1).tolist()


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_knn_estimator_equals_votes_by_hand(points, metric):
    df, x, y = points
    model = es.KNNJoinClassifier(k=4, metric=metric, weights="distance", weightMode="eps", idCol="id").fit(df.where("id < 200"))
    out = model.transform(df.where("id >= 200")).orderBy("id").collect()
    assert "probability" not in out[0].asDict()
    for r in out:
        diff = np.abs(x[:200] - x[r.id])
        d = diff.sum(1) if metric == "manhattan" else np.sqrt((diff**2).sum(1))
        near = np.lexsort((np.arange(200), d))[:4]
        votes = [sum(1 / (d[j] + 1e-8) for j in near if y[j] == c) for c in range(3)]
        assert r.prediction == int(np.argmax(votes))


def test_knn_probabilities_and_row_count(points):
    df, x, y = points
    model = es.KNNJoinClassifier(k=3, weights="uniform", probabilities=True, idCol="id").fit(df)
    out = model.transform(df.unionAll(df)).collect()       # repeated rows are scored row by row
    assert len(out) == 600
    for r in out[:50]:
        near = np.lexsort((np.arange(300), ((x - x[r.id]) ** 2).sum(1)))[:3]
        assert np.allclose(r.probability.toArray(), [(y[near] == c).mean() for c in range(3)])


def test_stages_survive_saving(points, tmp_path):
    df, *_ = points
    for stage in (es.ClosedFormNB(), es.KNNJoinClassifier(k=3, metric="cosine", idCol="id", probabilities=True)):
        pipe = Pipeline(stages=[es.PopulationScaler(inputCol="features", outputCol="z"), stage.setParams(featuresCol="z")
                                if hasattr(stage, "setParams") else stage._set(featuresCol="z")])
        model = pipe.fit(df)
        path = str(tmp_path / type(stage).__name__)
        model.save(path)
        a, b = (m.transform(df).select("id", "prediction", vector_to_array("probability").alias("p")).orderBy("id").collect()
                for m in (model, PipelineModel.load(path)))
        assert a == b and len(a) == 300


def test_estimators_without_rows(points):
    df, *_ = points
    for stage in (es.ClosedFormNB(), es.PopulationScaler(inputCol="features")):
        with pytest.raises(ValueError):
            stage.fit(df.limit(0))
    model = es.ClosedFormNB().fit(df)
    assert model.transform(df.limit(0)).count() == 0


def _risk_rows(spark):
    tx = src.load_tx(spark, SF_SMALL)
    return tx.withColumn("risk_category", F.when(F.col("isFraud") == 0, 0).when(F.col("amount") < 100, 1).otherwise(2))


def test_loaded_pipeline_scores_like_the_unsaved_one(spark):
    tx = _risk_rows(spark)
    forest = mo.random_forest(10, 5, binary=False, label="risk_category")
    model = ft.transaction_pipeline(forest).fit(tx)
    again = ft.load_fitted(ft.save_fitted(model, spark))
    new = src.new_transactions(spark)
    a, b = (sorted(map(tuple, ft.score_risk(m, new).collect())) for m in (model, again))
    assert a == b and len(a) == 4
    r = ft.score_risk(again, tx.drop("risk_category")).first()
    assert abs(r.p_normal + r.p_small + r.p_large - 1) < 1e-9 and (r.flag == "FRAUD") == (r.risk_category > 0)


def test_pipeline_encodes_unknown_and_null_types(spark):
    tx = _risk_rows(spark)
    model = ft.transaction_pipeline(es.ClosedFormNB(labelCol="risk_category"), scaled=True).fit(tx)
    cats = sorted(r[0] for r in tx.select("type").distinct().collect())
    odd = tx.limit(2).withColumn("type", F.when(F.col(KEY) % 2 == 0, "NEW"))
    assert {r.type_encoded for r in model.transform(odd).collect()} == {float(len(cats))}


def test_pipeline_scores_a_stream_like_a_batch(spark):
    tx = _risk_rows(spark)
    model = ft.load_fitted(ft.save_fitted(
        ft.transaction_pipeline(es.ClosedFormNB(labelCol="risk_category"), scaled=True).fit(tx), spark))
    stream = ft.score_risk(model, src.tx_from_events(events_stream(spark, SF_SMALL))).select(KEY, "risk_category", "p_large")
    q = stream.writeStream.format("memory").queryName("txrisk_fitted").outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    want = ft.score_risk(model, tx.drop("risk_category")).select(KEY, "risk_category", "p_large")
    got = spark.table("txrisk_fitted")
    assert got.count() == 1000 and got.exceptAll(want).count() == 0


def test_knn_estimator_in_the_evaluation(points):
    df, *_ = points
    binary = df.withColumn("label", (F.col("label") > 0).cast("int"))
    row = pl.evaluate_model("kNN", es.KNNJoinClassifier(idCol="id"), binary.where("id < 200"), binary.where("id >= 200")).first()
    assert row.model == "kNN" and row.accuracy > 0.6 and row.roc_auc is None
    with_p = pl.evaluate_model("kNN", es.KNNJoinClassifier(idCol="id", probabilities=True), binary.where("id < 200"),
                               binary.where("id >= 200")).first()
    assert with_p.accuracy == row.accuracy and 0.5 < with_p.roc_auc <= 1
