"""Own ``pyspark.ml`` estimators: population scaling (A13), logistic regression by
Newton steps (M1), closed-form Gaussian naive Bayes (M3) and the kNN join (M8-M10), so that they stand in a ``Pipeline``,
are evaluated like any library model (F3) and are saved and loaded with it.

Fitted numbers are ``Param`` values (saved as the stage's metadata). The kNN
model keeps the path of its training rows, written in the shared folder.
"""

from __future__ import annotations

import math
import os
import uuid

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasInputCol, HasLabelCol, HasOutputCol, HasPredictionCol,
                                     HasProbabilityCol)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, cut_lineage
from . import knn as kn
from . import models as mo
from . import scaling as sc
from .newton import fit_logistic, logistic


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    """Saved and loaded by its params."""

    def _width(self, df: DataFrame, col: str) -> int:
        first = df.where(F.col(col).isNotNull()).select(F.size(vector_to_array(col))).first()
        if first is None:
            raise ValueError("cannot be fitted without a row")
        return first[0]


def _columns(df: DataFrame, col: str, n: int, *more: str) -> tuple[DataFrame, list[str]]:
    x = vector_to_array(F.col(col))
    names = [f"f{i}" for i in range(n)]
    return df.select(*more, *[x[i].alias(c) for i, c in enumerate(names)]), names


# ---------------------------------------------------------------- scaling
class _ScalerParams(HasInputCol, HasOutputCol, Params):
    pass


class PopulationScaler(Estimator, _ScalerParams, _Stage):
    """A13 on a vector column: population std, zero std divides by 1."""

    @keyword_only
    def __init__(self, *, inputCol: str = "raw", outputCol: str = "features"):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(inputCol="raw", outputCol="features")

    def _fit(self, dataset: DataFrame) -> "PopulationScalerModel":
        flat, names = _columns(dataset, self.getInputCol(), self._width(dataset, self.getInputCol()))
        stats = sc.fit_scaler(flat, names)
        model = PopulationScalerModel()
        model._set(mean=[float(stats[c][0] or 0.0) for c in names], std=[float(stats[c][1] or 1.0) for c in names])
        return self._copyValues(model)


class PopulationScalerModel(Model, _ScalerParams, _Stage):
    mean = Param(Params._dummy(), "mean", "means", TypeConverters.toListFloat)
    std = Param(Params._dummy(), "std", "divisors", TypeConverters.toListFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(inputCol="raw", outputCol="features")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        by = F.arrays_zip(F.lit(self.getOrDefault("mean")).alias("m"), F.lit(self.getOrDefault("std")).alias("s"))
        x = F.zip_with(vector_to_array(F.col(self.getInputCol())), by, lambda v, p: (v - p["m"]) / p["s"])
        return dataset.withColumn(self.getOutputCol(), array_to_vector(x))


# ---------------------------------------------------------------- naive Bayes
class _ClassifierParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, Params):
    pass


class _NBParams(_ClassifierParams, HasProbabilityCol):
    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability")


class ClosedFormNB(Estimator, _NBParams, _Stage):
    """M3: priors, means and variances of each class by one grouped aggregation."""

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction",
                 probabilityCol: str = "probability"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ClosedFormNBModel":
        label = self.getLabelCol()
        named = dataset.where(F.col(label).isNotNull()).withColumn("_y", F.col(label).cast("double"))
        flat, names = _columns(named, self.getFeaturesCol(), self._width(named, self.getFeaturesCol()), "_y")
        fitted = mo.gnb_fit(flat, names, "_y")
        classes = sorted(fitted)
        model = ClosedFormNBModel()
        model._set(classes=classes, priors=[fitted[c]["prior"] for c in classes],
                   means=[float(v) for c in classes for v in fitted[c]["mean"]],
                   variances=[float(v) for c in classes for v in fitted[c]["var"]])
        return self._copyValues(model)


class ClosedFormNBModel(Model, _NBParams, _Stage):
    classes = Param(Params._dummy(), "classes", "class labels, rising", TypeConverters.toListFloat)
    priors = Param(Params._dummy(), "priors", "share of each class", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "means, class after class", TypeConverters.toListFloat)
    variances = Param(Params._dummy(), "variances", "smoothed variances, class after class", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        classes, priors, means, variances = (self.getOrDefault(p) for p in ("classes", "priors", "means", "variances"))
        d = len(means) // len(classes)
        x = vector_to_array(F.col(self.getFeaturesCol()))

        def joint(c: int):      # log prior + log density
            m, v = means[c * d:(c + 1) * d], variances[c * d:(c + 1) * d]
            known = F.arrays_zip(F.lit(m).alias("m"), F.lit(v).alias("v"))
            parts = F.zip_with(x, known, lambda a, p: (a - p["m"]) * (a - p["m"]) / (2.0 * p["v"]))
            start = math.log(priors[c]) - 0.5 * sum(math.log(2 * math.pi * s) for s in v)
            return F.aggregate(parts, F.lit(start), lambda acc, q: acc - q)

        logs = F.array(*[joint(c) for c in range(len(classes))])
        out = dataset.withColumn("_logs", logs).withColumn("_most", F.array_max("_logs"))
        shares = F.transform("_logs", lambda v: F.exp(v - F.col("_most")))
        out = out.withColumn("_shares", shares)
        total = F.aggregate("_shares", F.lit(0.0), lambda acc, v: acc + v)
        first = F.array_position("_logs", F.col("_most")).cast("int")       # a tie goes to the smaller class
        return out.withColumn("_total", total).withColumns({
            self.getProbabilityCol(): array_to_vector(F.transform("_shares", lambda v: v / F.col("_total"))),
            self.getPredictionCol(): F.element_at(F.lit(classes), first)}).drop("_logs", "_most", "_shares", "_total")


# ---------------------------------------------------------------- logistic regression
class _NewtonParams(_NBParams):
    weightCol = Param(Params._dummy(), "weightCol", "row weights", TypeConverters.toString)
    c = Param(Params._dummy(), "c", "inverse strength of the penalty", TypeConverters.toFloat)
    maxSteps = Param(Params._dummy(), "maxSteps", "Newton steps, at most", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "largest move of a coefficient at the end", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(c=1.0, maxSteps=100, tol=1e-10)


class NewtonLogisticRegression(Estimator, _NewtonParams, _Stage):
    """M1: one aggregation per Newton step (``newton.fit_logistic``)."""

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction",
                 probabilityCol: str = "probability", weightCol: str | None = None, c: float = 1.0,
                 maxSteps: int = 100, tol: float = 1e-10):
        super().__init__()
        self._set(**{name: v for name, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "NewtonLogisticModel":
        weight = self.getOrDefault("weightCol") if self.isDefined("weightCol") else None
        label = self.getLabelCol()
        w = F.col(weight).cast("double") if weight else F.lit(1.0)
        named = dataset.withColumn("_y", F.col(label).cast("double")).withColumn("_w", w)
        flat, names = _columns(named, self.getFeaturesCol(), self._width(named, self.getFeaturesCol()), "_y", "_w")
        fitted = fit_logistic(flat, names, "_y", "_w", *(self.getOrDefault(p) for p in ("c", "maxSteps", "tol")))
        model = NewtonLogisticModel()
        model._set(coefficients=fitted.coefficients, intercept=fitted.intercept)
        return self._copyValues(model)


class NewtonLogisticModel(Model, _NewtonParams, _Stage):
    coefficients = Param(Params._dummy(), "coefficients", "one per feature", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(F.col(self.getFeaturesCol()))
        parts = F.zip_with(x, F.lit(self.getOrDefault("coefficients")), lambda a, b: a * b)
        z = F.aggregate(parts, F.lit(self.getOrDefault("intercept")), lambda acc, v: acc + v)
        out = dataset.withColumn("_p", logistic(z))
        return out.withColumns({self.getProbabilityCol(): array_to_vector(F.array(1.0 - F.col("_p"), F.col("_p"))),
                                self.getPredictionCol(): (F.col("_p") > 0.5).cast("double")}).drop("_p")


# ---------------------------------------------------------------- kNN
class _KNNParams(_ClassifierParams, HasProbabilityCol):
    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    metric = Param(Params._dummy(), "metric", "euclidean, manhattan or cosine", TypeConverters.toString)
    weights = Param(Params._dummy(), "weights", "uniform or distance", TypeConverters.toString)
    weightMode = Param(Params._dummy(), "weightMode", "eps (hand-written) or exact_match (library)", TypeConverters.toString)
    probabilities = Param(Params._dummy(), "probabilities", "add class probabilities (M10)", TypeConverters.toBoolean)
    idCol = Param(Params._dummy(), "idCol", "id of training rows: ties go to the smaller one", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction",
                         probabilityCol="probability", k=5, metric="euclidean", weights="uniform",
                         weightMode="exact_match", probabilities=False)


class KNNJoinClassifier(Estimator, _KNNParams, _Stage):
    """M8/M9: keeps the training rows, classifies by the exact kNN join."""

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction",
                 probabilityCol: str = "probability", k: int = 5, metric: str = "euclidean", weights: str = "uniform",
                 weightMode: str = "exact_match", probabilities: bool = False, idCol: str | None = None):
        super().__init__()
        self._set(**{name: v for name, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "KNNJoinModel":
        folder = checkpoint_dir(dataset.sparkSession)
        if folder is None:
            raise ValueError("set spark.checkpoint.dir: the model keeps its training rows there")
        tid = F.col(self.getOrDefault("idCol")) if self.isDefined("idCol") else F.monotonically_increasing_id()
        path = os.path.join(folder, f"knn-{uuid.uuid4().hex}")
        dataset.select(tid.cast("bigint").alias("tid"), vector_to_array(F.col(self.getFeaturesCol())).alias("vec"),
                       F.col(self.getLabelCol()).cast("double").alias("label")) \
            .where(F.col("label").isNotNull()).write.parquet(path)
        labels = dataset.sparkSession.read.parquet(path).select("label").distinct().orderBy("label").collect()
        model = KNNJoinModel()
        model._set(trainPath=path, classes=[r[0] for r in labels])
        return self._copyValues(model)


class KNNJoinModel(Model, _KNNParams, _Stage):
    trainPath = Param(Params._dummy(), "trainPath", "the training rows", TypeConverters.toString)
    classes = Param(Params._dummy(), "classes", "class labels, rising", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        train = dataset.sparkSession.read.parquet(get("trainPath"))
        # Rows are numbered and written once, so that the ids stay what they are.
        rows = cut_lineage(dataset.withColumn("_row", F.monotonically_increasing_id()))
        asked = rows.select(F.col("_row").alias("qid"), vector_to_array(F.col(self.getFeaturesCol())).alias("vec"))
        nn = cut_lineage(kn.knn_join(asked, train, get("k"), get("metric"), label="label"))
        out = kn.knn_predict(nn, get("weights"), get("weightMode")).withColumnRenamed("prediction", "_said")
        if get("probabilities"):
            shares = kn.knn_proba(nn, get("classes"), get("weights"), get("weightMode")).groupBy("qid") \
                .agg(F.sort_array(F.collect_list(F.struct("label", "proba"))).alias("_by"))
            out = out.join(shares, "qid").withColumn("_by", array_to_vector(F.col("_by.proba")))
        done = rows.join(out, F.col("_row") == F.col("qid")).withColumn(self.getPredictionCol(), F.col("_said"))
        if get("probabilities"):
            done = done.withColumn(self.getProbabilityCol(), F.col("_by")).drop("_by")
        return done.drop("_row", "qid", "_said")
