"""Composite operators: scatter sample, evaluation, leaderboard, presets."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantile import exact_percentile_wide
from ..operators import ensemble as en
from ..operators import estimators as es
from ..operators import features as fe
from ..operators import metrics as me
from ..operators import models as mo
from ..operators import sampling as sa
from ..operators import scaling as sc
from ..operators import stats as st
from ..operators.smote import smote
from ..schema import CLASS_NAMES, FEATURE_COLS, KEY, LABEL
from ..session import cache_memory, cut_lineage


def scatter_sample(feat: DataFrame, cols: Sequence[str], n_each: int = 1500,
                   label: str = LABEL, seed: int = 42) -> DataFrame:
    """Balanced sample, each column capped at the *sample's* exact p99,
    class name attached."""
    s = cut_lineage(sa.balanced_sample(feat.select(KEY, *cols, label), n_each, label, seed))
    long = st.long_form(s, cols)
    caps = {r["feature"]: r["v"] for r in
            exact_percentile_wide(long, "x", [0.99], by=["feature"], names=["v"]).collect()}
    s = fe.clip_columns(s, {c: v for c, v in caps.items() if v is not None})
    return s.select(KEY, *cols, fe.code_to_name(F.col(label), CLASS_NAMES).alias("class_name"))


# ---------------------------------------------------------------- M13-M17

# ---- fixed values: model presets of the study --------------------------------
LR_ITERATIONS = 1000
VOTING_LR_ITERATIONS = 500
TREE_DEPTH = 10
BALANCED_TREE_DEPTH = 12      # after SMOTE or undersampling
VOTING_TREE_DEPTH = 10
STACKING_TREE_DEPTH = 8
FOREST = (100, 15)            # trees, depth
BOOSTING = (200, 6, 0.1)      # rounds, depth, rate; positive class weighted n0 / n1
BOOSTING_FALLBACK = (100, 5, 0.1)     # unweighted
RISK_FOREST = (100, 12)
SMOTE_RATIO = 0.1
# -------------------------------------------------------------------------------


DEALT_FROM = 20_000           # rows from which a frame is dealt evenly over the cores
DEALT_ROWS = 500_000          # of a partition, at most


def dealt(df: DataFrame) -> DataFrame:
    """A fit's many jobs have one task a partition, and a table of few file parts
    leaves cores idle: rows are dealt evenly, at least a partition a core."""
    n, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return df if n < DEALT_FROM else df.repartition(cores * max(1, -(-n // (DEALT_ROWS * cores))))


_dealt = dealt


def prepare(feat: DataFrame, scaled: bool = False, features=FEATURE_COLS, label: str = LABEL,
            seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Script preset: stratified split, balanced weights and, if ``scaled``, a
    scaler fitted on train only; (train, test) with ``features`` vectors,
    ``label`` and ``weight`` columns, both written once."""
    split = sa.stratified_split(feat, label=label, seed=seed).withColumnRenamed(label, "label")
    split = cut_lineage(split)
    train, test = (dealt(split.where(F.col("split") == part)) for part in ("train", "test"))
    if scaled:
        stats = sc.fit_scaler(train, features)
        train, test = sc.apply_scaler(train, stats), sc.apply_scaler(test, stats)
    train = st.with_weights(train, "label")
    return cut_lineage(mo.assemble(train, features)), cut_lineage(mo.assemble(test, features))


SCALED_COLS = (KEY, "label", "weight", "features")


def scaled_frames(train: DataFrame, test: DataFrame, features=FEATURE_COLS) -> tuple[DataFrame, DataFrame]:
    """What ``prepare`` gives with ``scaled``, from its unscaled frames: rows are
    neither split nor dealt again and stay in their partitions. Only key, label,
    weight and vector are written, as fits read a frame several times."""
    stats = sc.fit_scaler(train, features)
    return tuple(cut_lineage(mo.assemble(sc.apply_scaler(df.drop("features"), stats), features)
                             .select(*[c for c in SCALED_COLS if c in df.columns])) for df in (train, test))


def evaluate_model(name: str, estimator, train: DataFrame, test: DataFrame) -> DataFrame:
    """Fit (timed), predict; one metrics row."""
    pred, secs = predicted(estimator, train, test)
    return evaluate_predictions(name, pred, secs, "score" if "score" in pred.columns else None)


def predicted(estimator, train: DataFrame, test: DataFrame) -> tuple[DataFrame, float]:
    """Predictions for the test rows, and the seconds of the fit."""
    t0 = time.time()
    model = estimator.fit(train)
    return mo.predict_binary(model, test), time.time() - t0


def evaluate_predictions(name: str, pred: DataFrame, secs: float | None, score: str | None = "score") -> DataFrame:
    """One metrics row; ``score`` None (no probabilities) leaves the AUC NULL."""
    return evaluate_all({name: (pred if score else pred.drop("score"), secs)}, score or "score")


def evaluate_all(predictions: dict[str, tuple[DataFrame, float | None]], score: str = "score") -> DataFrame:
    """One metrics row per model (name -> predictions, seconds of the fit), all
    from one aggregation; predictions without a ``score`` column have no AUC."""
    rows, seconds = None, F.create_map(*[x for m, (_, t) in predictions.items()
                                         for x in (F.lit(m), F.lit(t).cast("double"))])
    for name, (pred, _) in predictions.items():
        s = F.col(score).cast("double") if score in pred.columns else F.lit(None).cast("double")
        part = pred.select(F.lit(name).alias("model"), F.col("label").cast("int").alias("label"),
                           F.col("prediction").cast("int").alias("prediction"), s.alias("score"))
        rows = part if rows is None else rows.unionByName(part)
    return me.report_rows(rows, "model").select("model", "accuracy", "precision", "recall", "f1", "roc_auc",
                                                seconds[F.col("model")].alias("train_seconds"))


def _pos_weighted(train: DataFrame) -> DataFrame:
    r = st.pos_weight(train, "label").first()
    return train.withColumn("pw", F.when(F.col("label") == 1, F.lit(r["pos_weight"] or 1.0)).otherwise(1.0))


def voting_bases(n: float, tree_depth: int) -> dict:
    return {"lr": lambda: mo.logistic_regression(n, VOTING_LR_ITERATIONS, "weight"),
            "dt": lambda: mo.decision_tree(tree_depth, weight_col="weight"), "nb": mo.gaussian_nb}


def closed_bases() -> dict:
    """Bases fitted by aggregations alone (no library solver)."""
    return {"lr": lambda: es.NewtonLogisticRegression(weightCol="weight"), "nb": es.ClosedFormNB}


def run_within(tasks: dict[str, Callable], sizes: dict[str, float], room: float) -> dict:
    """Results of all tasks by name. They start in the given order, at the same time as
    long as their sizes together keep within ``room``; a larger one runs by itself."""
    waiting, running, done = dict(tasks), {}, {}
    with ThreadPoolExecutor(max(1, len(tasks))) as pool:
        while waiting or running:
            for name in list(waiting):
                if not running or sum(sizes[n] for n in running.values()) + sizes[name] <= room:
                    running[pool.submit(waiting.pop(name))] = name
            for ended in wait(running, return_when=FIRST_COMPLETED).done:
                done[running.pop(ended)] = ended.result()
    return done


# Bytes a fit of the library keeps cached for a train row, about: its binned or blocked
# features, a forest's draws of all trees, the margins of boosting.
CACHED_BYTES = {"forest": 150 + 4 * FOREST[0], "boosting": 270, "naive_bayes": 0}
CACHED_BYTES_ELSE = 140
CACHE_SHARE = 0.75            # of the cache memory that fits at the same time may fill


class Study:
    """The nine models of the study over one feature table. A model is fitted
    when its row is asked for; the split frames are written once."""

    def __init__(self, feat: DataFrame):
        self.feat, self._frames = feat, {}

    def frames(self, scaled: bool) -> tuple[DataFrame, DataFrame]:
        if scaled not in self._frames:
            made = scaled and False in self._frames
            self._frames[scaled] = scaled_frames(*self._frames[False]) if made else prepare(self.feat, scaled)
        return self._frames[scaled]

    def _fit(self, estimator, scaled=False, weigh=lambda df: df):
        train, test = self.frames(scaled)
        return predicted(estimator, weigh(train), test)

    def _resampled(self, resample):
        train, test = self.frames(False)
        df = resample(train.select(KEY, *FEATURE_COLS, F.col("label").alias(LABEL)))
        df = cut_lineage(mo.assemble(df.withColumnRenamed(LABEL, "label"), FEATURE_COLS))
        return predicted(mo.decision_tree(BALANCED_TREE_DEPTH), df, test)

    def logistic(self):
        return self._fit(mo.logistic_regression(float(self.frames(True)[0].count()), LR_ITERATIONS, "weight"), True)

    def tree(self):
        return self._fit(mo.decision_tree(TREE_DEPTH, weight_col="weight"))

    def naive_bayes(self):
        return self._fit(mo.gaussian_nb(), True)

    def tree_smote(self):
        return self._resampled(lambda df: smote(df, FEATURE_COLS, ratio=SMOTE_RATIO))

    def tree_undersampled(self):
        return self._resampled(lambda df: sa.undersample(df, ratio=SMOTE_RATIO))

    def forest(self):
        return self._fit(mo.random_forest(*FOREST, weight_col="weight"))

    def boosting(self):
        return self._fit(mo.boosting(*BOOSTING, weight_col="pw"), weigh=_pos_weighted)

    def voting(self):
        train, test = self.frames(True)
        t0 = time.time()
        models = en.fit_bases(train, voting_bases(float(train.count()), VOTING_TREE_DEPTH))
        secs = time.time() - t0
        return en.soft_vote(en.apply_bases(models, test), list(models)), secs

    def stacking(self):
        train, test = self.frames(True)
        t0 = time.time()
        pred = en.stacking(train, test, voting_bases(float(train.count()), STACKING_TREE_DEPTH),
                           lambda n: mo.logistic_regression(n, VOTING_LR_ITERATIONS, None), key=KEY)
        return pred, time.time() - t0

    NAMES = {"logistic": "Logistic Regression", "tree": "Decision Tree", "naive_bayes": "Naive Bayes",
             "tree_smote": "Decision Tree + SMOTE", "tree_undersampled": "Decision Tree + undersampling",
             "forest": "Random Forest", "boosting": "Gradient Boosting", "voting": "Soft Voting", "stacking": "Stacking"}
    MODELS = tuple(NAMES)
    BALANCING = ("tree", "tree_smote", "tree_undersampled")
    SCALED = ("logistic", "naive_bayes", "voting", "stacking")

    def row(self, model: str) -> DataFrame:
        """The metrics row of one model."""
        return self.board((model,))

    LONGEST_FIRST = ("boosting", "forest", "stacking", "voting", "tree_smote", "tree_undersampled", "logistic", "tree",
                     "naive_bayes")

    def board(self, models=MODELS) -> DataFrame:
        """One row per model, best F1 first. Each model is fitted once, as many at
        the same time as the executors can cache (a fit is many short jobs in a row,
        which leave cores idle; but every one of them reads the cached rows, and fits that
        push each other's rows to disk read them from there each time); the predictions
        of all are evaluated in one grouped aggregation."""
        for scaled in sorted({m in self.SCALED for m in models}):
            self.frames(scaled)         # written once, before the fits share them
        spark, rows = self.feat.sparkSession, max((train.count() for train, _ in self._frames.values()), default=0)
        order = sorted(models, key=lambda m: self.LONGEST_FIRST.index(m) if m in self.LONGEST_FIRST else 0)
        fits = run_within({m: inheritable_thread_target(spark)(getattr(self, m)) for m in order},
                          {m: rows * CACHED_BYTES.get(m, CACHED_BYTES_ELSE) for m in order},
                          CACHE_SHARE * cache_memory(spark))
        return leaderboard([evaluate_all({self.NAMES[m]: fits[m] for m in models})])


BALANCING_NAMES = ("Decision Tree", "Decision Tree + SMOTE", "Decision Tree + undersampling")


def balancing_comparison(board: DataFrame, names=BALANCING_NAMES) -> DataFrame:
    """The board's rows of the named models, without accuracy and AUC."""
    return board.where(F.col("model").isin(*names)).select("model", "precision", "recall", "f1")


def leaderboard(rows: list[DataFrame]) -> DataFrame:
    """M14 + K3: all metric rows, best F1 first (ties by model name)."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.orderBy(F.col("f1").desc(), "model")


def metric_ranking(board: DataFrame) -> DataFrame:
    """K4: per metric, models ranked, NULL metric values left out."""
    metrics = ["accuracy", "precision", "recall", "f1", "roc_auc"]
    long = board.select("model", *metrics).unpivot(["model"], metrics, "metric", "value").where(
        F.col("value").isNotNull())
    return long.withColumn("rank", F.row_number().over(
        Window.partitionBy("metric").orderBy(F.col("value").desc(), "model")))
