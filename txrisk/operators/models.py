"""Model presets on pyspark.ml, plus a closed-form
Gaussian naive Bayes (M3) written as aggregations (oracle-checkable).

T30: for a binary gini tree / forest we fit the *regressor* on the 0/1 label
(variance = gini / 2, leaf mean = P(1)), so leaf probabilities survive; the
classifier is used for entropy and multiclass.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       NaiveBayes, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

MAX_DEPTH = 30   # Spark's limit; the library's unlimited depth maps here (T31)
GNB_VAR_SMOOTHING = 1e-9   # fixed value: variance smoothing factor


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def _depth(d):
    """None (unlimited) is Spark's limit (T31); a larger explicit depth is an error."""
    if d is not None and int(d) > MAX_DEPTH:
        raise ValueError(f"max_depth {d} is over Spark's limit of {MAX_DEPTH}")
    return MAX_DEPTH if d is None else int(d)


def logistic_regression(n_weight_sum: float, max_iter: int = 1000, weight_col: str | None = "weight",
                        label: str = "label", tol: float = 1e-4) -> LogisticRegression:
    """M1: L2, C = 1 -> regParam = 1 / sum(weights) (no standardisation);
    the library's default tolerance 1e-4."""
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter, tol=tol,
                            regParam=1.0 / max(n_weight_sum, 1.0), elasticNetParam=0.0,
                            standardization=False, probabilityCol="probability")
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


def decision_tree(max_depth=10, criterion: str = "gini", binary: bool = True, weight_col: str | None = None,
                  label: str = "label", seed: int = 42, max_bins: int = 256) -> Estimator:
    """M2."""
    if binary and criterion == "gini":
        est = DecisionTreeRegressor(featuresCol="features", labelCol=label, maxDepth=_depth(max_depth),
                                    maxBins=max_bins, seed=seed, predictionCol="p1")
    else:
        est = DecisionTreeClassifier(featuresCol="features", labelCol=label, maxDepth=_depth(max_depth),
                                     maxBins=max_bins, impurity=criterion, seed=seed)
    if weight_col:
        est.setWeightCol(weight_col)
    return est


def random_forest(n_trees=100, max_depth=15, criterion="gini", max_features="sqrt", binary=True,
                  weight_col: str | None = None, label: str = "label", seed: int = 42,
                  max_bins: int = 64) -> Estimator:
    """M4 (``max_features=None`` -> all features)."""
    fss = "all" if max_features is None else max_features
    if binary and criterion == "gini":
        est = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=n_trees,
                                    maxDepth=_depth(max_depth), featureSubsetStrategy=fss, seed=seed,
                                    maxBins=max_bins, predictionCol="p1")
    else:
        est = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=n_trees,
                                     maxDepth=_depth(max_depth), featureSubsetStrategy=fss, seed=seed,
                                     impurity=criterion, maxBins=max_bins)
    if weight_col:
        est.setWeightCol(weight_col)
    return est


def boosting(n_rounds=200, max_depth=6, rate=0.1, weight_col: str | None = None, label: str = "label",
             seed: int = 42) -> GBTClassifier:
    """M5: gradient-boosted trees (library preset 200 x 6 @ 0.1 with pos-weight)."""
    est = GBTClassifier(featuresCol="features", labelCol=label, maxIter=n_rounds, maxDepth=_depth(max_depth),
                        stepSize=rate, seed=seed)
    if weight_col:
        est.setWeightCol(weight_col)
    return est


def gaussian_nb(label: str = "label") -> NaiveBayes:
    """M3 through pyspark.ml."""
    return NaiveBayes(featuresCol="features", labelCol=label, modelType="gaussian")


def predict_binary(model, df: DataFrame, label: str = "label") -> DataFrame:
    """Uniform output (label, prediction, score = P(1)) for any binary
    model (regressor trick: p1 > 0.5); no score without probabilities."""
    out = model.transform(df)
    if "p1" in out.columns:
        p1 = F.least(F.greatest(F.col("p1"), F.lit(0.0)), F.lit(1.0))
        return out.withColumn("score", p1).withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    if "probability" in out.columns:
        out = out.withColumn("score", vector_to_array("probability")[1])
    return out.withColumn("prediction", F.col("prediction").cast("int"))


def importances(model, features: Sequence[str], top_n: int = 12) -> DataFrame:
    """M12 + K2: normalised importances, top n, ties by name."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    vals = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(list(features), [float(v) for v in vals])),
                               "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(top_n)


def tree_nodes(model, features: Sequence[str], max_depth_display: int = 4, tree_id: int | None = None) -> DataFrame:
    """Node table from the persisted model (shared checkpoint folder),
    the first levels found by following child links (tiny table)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    base = checkpoint_dir(spark)
    if base is None:
        raise ValueError("set spark.checkpoint.dir to a shared folder to export trees")
    path = os.path.join(base, f"tree-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(os.path.join(path, "data"))
    if "treeID" in nodes.columns:
        nodes = nodes.where(F.col("treeID") == (tree_id or 0)).select("nodeData.*")
    names = F.array(*[F.lit(c) for c in features])
    nodes = nodes.select("id", "prediction", "impurity", "gain", "leftChild", "rightChild",
                         F.when(F.col("leftChild") >= 0, F.element_at(names, F.col("split.featureIndex") + 1))
                         .alias("feature"),
                         F.when(F.col("leftChild") >= 0, F.element_at("split.leftCategoriesOrThreshold", 1))
                         .alias("threshold"))
    level = nodes.where(F.col("id") == 0).select("id", F.lit(0).alias("depth"))
    seen = level
    for d in range(1, max_depth_display + 1):
        kids = (level.join(nodes, "id").select(F.explode(F.array("leftChild", "rightChild")).alias("id"))
                .where(F.col("id") >= 0).select("id", F.lit(d).alias("depth")))
        seen = seen.unionByName(kids)
        level = kids
    return nodes.join(seen, "id")


# ---------------------------------------------------------------- M3 in SQL form
def gnb_fit(train: DataFrame, features: Sequence[str], label: str = "label") -> dict:
    """Priors, per-class means and variances (+ epsilon = 1e-9 * the largest
    feature variance over all rows). One grouped aggregation + one global;
    the fitted table (classes x features) reaches the driver."""
    feats = list(features)
    glob = train.agg(*[F.var_pop(c).alias(c) for c in feats]).first()
    eps = GNB_VAR_SMOOTHING * max((glob[c] or 0.0) for c in feats)
    rows = train.groupBy(label).agg(F.count(F.lit(1)).alias("_n"),
                                    *[F.avg(c).alias(f"m_{c}") for c in feats],
                                    *[F.var_pop(c).alias(f"v_{c}") for c in feats]).collect()
    n = sum(r["_n"] for r in rows)
    return {r[label]: {"prior": r["_n"] / n, "mean": [r[f"m_{c}"] for c in feats],
                       "var": [r[f"v_{c}"] + eps for c in feats]} for r in rows}


def gnb_predict(df: DataFrame, params: dict, features: Sequence[str], proba: str | None = None) -> DataFrame:
    """Joint log-likelihood per class as column expressions; prediction =
    argmax (tie -> smaller class); score = P(largest class); with ``proba`` an
    array column of all class probabilities, in class order."""
    feats = list(features)
    classes = sorted(params)
    jll = {}
    for c in classes:
        p = params[c]
        e = F.lit(math.log(p["prior"]) - 0.5 * sum(math.log(2.0 * math.pi * v) for v in p["var"]))
        for f, m, v in zip(feats, p["mean"], p["var"]):
            e = e - (F.col(f) - F.lit(m)) * (F.col(f) - F.lit(m)) / F.lit(2.0 * v)
        jll[c] = e
    out = df.withColumns({f"_jll{i}": jll[c] for i, c in enumerate(classes)})
    if not classes:
        raise ValueError("naive Bayes was fitted without a labelled row")
    best = F.lit(classes[0])
    bestv = F.col("_jll0")
    for i, c in enumerate(classes[1:], start=1):
        better = F.col(f"_jll{i}") > bestv
        best = F.when(better, F.lit(c)).otherwise(best)
        bestv = F.greatest(bestv, F.col(f"_jll{i}"))
    out = out.withColumn("prediction", best).withColumn("_mx", bestv)
    lse = F.col("_mx") + F.log(sum((F.exp(F.col(f"_jll{i}") - F.col("_mx")) for i in range(len(classes))),
                                   F.lit(0.0)))
    out = out.withColumn("score", F.exp(F.col(f"_jll{len(classes) - 1}") - lse))
    if proba:
        out = out.withColumn(proba, F.array(*[F.exp(F.col(f"_jll{i}") - lse) for i in range(len(classes))]))
    return out.drop(*[f"_jll{i}" for i in range(len(classes))], "_mx")
