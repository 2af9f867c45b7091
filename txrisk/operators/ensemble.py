"""M6 soft voting and M7 stacking, composed from pyspark.ml models.

Models are applied one after another to the same rows (each writes its own
P(1) column), so no join is needed to line predictions up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import models as mo
from .sampling import stratified_folds


def _score_as(model, df: DataFrame, name: str) -> DataFrame:
    keep = df.columns
    out = mo.predict_binary(model, df)
    return out.select(*keep, F.col("score").alias(name))


def fit_bases(train: DataFrame, bases: dict) -> dict:
    return {n: est_fn().fit(train) for n, est_fn in bases.items()}


def apply_bases(models: dict, df: DataFrame) -> DataFrame:
    for n, m in models.items():
        df = _score_as(m, df, f"p_{n}")
    return df


def soft_vote(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean P(1); predict 1 only if it beats P(0) (a tie goes to class 0)."""
    mean = sum((F.col(f"p_{n}") for n in names), F.lit(0.0)) / len(names)
    return df.withColumn("score", mean).withColumn("prediction", (F.col("score") > 0.5).cast("int"))


def out_of_fold(train: DataFrame, bases: dict, n_folds: int = 3, key: str = "row_key",
                label: str = "label") -> DataFrame:
    """``p_<base>`` of every row from bases fitted on the other folds."""
    folded = cut_lineage(stratified_folds(train, n_folds, label=label, key=key))
    parts = None
    for f in range(n_folds):
        models = fit_bases(folded.where(F.col("fold") != f), bases)
        scored = apply_bases(models, folded.where(F.col("fold") == f))
        parts = scored if parts is None else parts.unionByName(scored)
    return cut_lineage(parts)


def stacking(train: DataFrame, test: DataFrame, bases: dict, meta_fn, n_folds: int = 3,
             key: str = "row_key", label: str = "label") -> DataFrame:
    """Out-of-fold P(1) of every base (stratified folds) trains the meta
    model (``meta_fn(n_rows)``); bases refitted on all train rows score the
    test rows."""
    oof = out_of_fold(train, bases, n_folds, key, label)
    names = list(bases)
    meta_in = mo.assemble(oof.drop("features"), [f"p_{n}" for n in names], "features")
    meta = meta_fn(float(oof.count())).fit(meta_in)
    full = apply_bases(fit_bases(train, bases), test)
    meta_test = mo.assemble(full.drop("features"), [f"p_{n}" for n in names], "features")
    return mo.predict_binary(meta, meta_test)
