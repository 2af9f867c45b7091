"""M1 by aggregation against the library's solver and a dense optimum."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel

from conftest import SF_SMALL
from txrisk.operators import ensemble as en
from txrisk.operators import estimators as es
from txrisk.operators import features as fe
from txrisk.operators import models as mo
from txrisk.operators.newton import fit_logistic
from txrisk.plans import pipeline as pl
from txrisk.plans import sql as S
from txrisk.schema import FEATURE_COLS
from txrisk.sources import transactions as src


def _rows(spark, n=400, d=3, seed=0, shift=0.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * [1.0, 3.0, 0.2][:d]
    y = (rng.random(n) < 1 / (1 + np.exp(-(x @ [1.0, -0.5, 2.0][:d] + shift)))).astype(int)
    w = rng.uniform(0.5, 3, n)
    df = spark.createDataFrame([(*map(float, v), int(c), float(u)) for v, c, u in zip(x, y, w)],
                               "a double, b double, c double, label int, weight double")
    return df, x, y, w


def _gradient(fit, x, y, w, c):
    b = np.array(fit.coefficients)
    p = 1 / (1 + np.exp(-(x @ b + fit.intercept)))
    return x.T @ (w * (p - y)) + b / c, (w * (p - y)).sum()


@pytest.mark.parametrize("c", [1.0, 0.01, 100.0])
def test_gradient_vanishes_at_the_fit(spark, c):
    df, x, y, w = _rows(spark)
    fit = fit_logistic(df, ["a", "b", "c"], weight="weight", c=c)
    slope, base = _gradient(fit, x, y, w, c)
    assert np.abs(slope).max() < 1e-7 and abs(base) < 1e-7 and fit.steps < 30


def test_coefficients_equal_the_librarys(spark):
    df, *_ = _rows(spark, shift=-2.0)
    mine = fit_logistic(df, ["a", "b", "c"], weight="weight")
    total = df.agg({"weight": "sum"}).first()[0]
    theirs = mo.logistic_regression(total, 1000, "weight", tol=1e-12).fit(mo.assemble(df, ["a", "b", "c"]))
    assert np.allclose(mine.coefficients, theirs.coefficients.toArray(), rtol=1e-5, atol=1e-7)
    assert abs(mine.intercept - theirs.intercept) < 1e-5


def test_separable_and_one_class(spark):
    df = spark.createDataFrame([(float(i), int(i > 5)) for i in range(12)], "a double, label int")
    fit = fit_logistic(df, ["a"], c=1e4)                    # nearly without penalty, steps are halved
    assert np.isfinite(fit.coefficients[0]) and fit.coefficients[0] > 1
    one = fit_logistic(df.where("label = 1"), ["a"], max_steps=20)
    assert np.isfinite(one.loss) and one.intercept > 3 and one.loss < 0.1


def test_nulls_and_wrong_labels(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 0), (0.5, 0), (2.0, None), (-1.0, 0), (3.0, 1)], "a double, label int")
    assert fit_logistic(df, ["a"]) == fit_logistic(df.dropna(), ["a"])
    with pytest.raises(ValueError):
        fit_logistic(df.na.fill(2, ["label"]), ["a"])
    with pytest.raises(ValueError):
        fit_logistic(df, ["a"], c=0)


def test_estimator_on_the_study_and_saved(spark, tmp_path):
    tx = src.load_tx(spark, SF_SMALL)
    study = pl.Study(fe.feature_table(tx, fe.fit_type_codes(tx)))
    train, test = study.frames(True)
    est = es.NewtonLogisticRegression(weightCol="weight")
    row = pl.evaluate_model("lr", est, train, test).first()
    n = float(train.count())
    exact = pl.evaluate_model("lr", mo.logistic_regression(n, 1000, "weight", tol=1e-12), train, test).first()
    assert row.f1 == exact.f1 and abs(row.roc_auc - exact.roc_auc) < 1e-9
    model = Pipeline(stages=[est]).fit(train)
    model.save(str(tmp_path / "m"))
    a, b = (m.transform(test).select("prediction", "probability").collect()
            for m in (model, PipelineModel.load(str(tmp_path / "m"))))
    assert a == b and len(model.stages[0].getOrDefault("coefficients")) == len(FEATURE_COLS)


@pytest.mark.parametrize("penalty", [1.0, 50.0])
def test_sql_steps_reach_the_same_coefficients(spark, penalty):
    parts, fits = [], []
    for g, shift in enumerate((0.0, -2.0)):
        df, x, y, w = _rows(spark, seed=g, shift=shift)
        fits.append(fit_logistic(df, ["a", "b", "c"], weight="weight", c=1 / penalty))
        parts.append(pd.DataFrame({"g": g, "y": y, "w": w, "x1": x[:, 0], "x2": x[:, 1], "x3": x[:, 2], "x4": 1.0}))
    con = duckdb.connect()
    con.register("rows_", pd.concat(parts))
    found = con.execute("WITH RECURSIVE " + S.newton_cte("rows_", 4, "nw", 20, penalty)
                        + " SELECT b FROM nw WHERE step = 20 ORDER BY g").fetchall()
    for fit, (b,) in zip(fits, found):
        assert np.allclose([*fit.coefficients, fit.intercept], b, rtol=1e-9, atol=1e-11)


def test_stacking_over_closed_bases(spark):
    """The meta model sees out-of-fold scores: every fold's bases are refitted here by hand."""
    df, *_ = _rows(spark, n=150)
    rows = mo.assemble(df.selectExpr("*", "monotonically_increasing_id() AS row_key"), ["a", "b", "c"])
    oof = en.out_of_fold(rows, pl.closed_bases()).toPandas()
    assert sorted(oof.row_key) == sorted(r[0] for r in rows.select("row_key").collect())
    for fold in range(3):
        rest, held = oof[oof.fold != fold], oof[oof.fold == fold]
        fit = fit_logistic(spark.createDataFrame(rest[["a", "b", "c", "label", "weight"]]), ["a", "b", "c"], weight="weight")
        z = held[["a", "b", "c"]].to_numpy() @ fit.coefficients + fit.intercept
        assert np.allclose(held.p_lr, 1 / (1 + np.exp(-z)), atol=1e-9)
    pred = en.stacking(rows, rows, pl.closed_bases(), lambda n: es.NewtonLogisticRegression())
    assert pred.count() == 150 and pred.where("(score > 0.5) <> (prediction = 1)").count() == 0
