"""M1 by aggregation: L2-penalised logistic regression by Newton steps.

Each step is one partial aggregation over the rows: the weighted loss, its
gradient and the cross sums of the Hessian at the current coefficients, a few
hundred numbers whatever the rows. The (d + 1) x (d + 1) system is solved on the
driver. A step that does not lower the loss is halved.

The objective is the library's: ``sum(w * logloss) + |b|^2 / (2 C)``; the
intercept is not penalised, features are taken as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

HALVINGS = 40


@dataclass
class LogisticFit:
    coefficients: list[float]
    intercept: float
    loss: float
    steps: int


def logistic(z: Column) -> Column:
    """1 / (1 + exp(-z)) without overflow."""
    e = F.exp(-F.abs(z))
    return F.when(z >= 0, 1.0 / (1.0 + e)).otherwise(e / (1.0 + e))


def _at(rows: DataFrame, n: int, beta: np.ndarray):
    """Loss, gradient and Hessian of the data term at ``beta`` (intercept last).
    Each partition sums its rows; the sums are added per place. (Generated code
    for that many sums would be compiled again for every step's coefficients.)"""
    places = np.triu_indices(n)

    def sums(it):
        total = np.zeros(1 + n + len(places[0]))
        for b in it:
            *xs, y, w = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            x = np.column_stack([*xs, np.ones(len(y))])
            z = x @ beta
            e = np.exp(-np.abs(z))
            p = np.where(z >= 0, 1 / (1 + e), e / (1 + e))
            miss = np.where(y == 1, -z, z)                  # loss = log(1 + exp(miss))
            total[0] += (w * (np.maximum(miss, 0) + np.log1p(e))).sum()
            total[1:1 + n] += x.T @ (w * (p - y))
            total[1 + n:] += (x.T @ (x * (w * p * (1 - p))[:, None]))[places]
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["v"])

    added = rows.mapInArrow(sums, "v array<double>").select(F.posexplode("v")).groupBy("pos").agg(F.sum("col").alias("s"))
    row = np.zeros(1 + n + len(places[0]))
    for r in added.collect():               # one row a place
        row[r["pos"]] = r["s"]
    hessian = np.zeros((n, n))
    hessian[places] = row[1 + n:]
    return row[0], row[1:1 + n], hessian + np.triu(hessian, 1).T


def fit_logistic(train: DataFrame, features: Sequence[str], label: str = "label", weight: str | None = None,
                 c: float = 1.0, max_steps: int = 100, tol: float = 1e-10) -> LogisticFit:
    """Fit on numeric ``features`` and a 0/1 ``label``.

    Rows with a NULL label, weight or feature are left out; other labels are an
    error. Steps end when no coefficient moves by over ``tol`` of its size (or
    of one).
    """
    if c <= 0:
        raise ValueError("c must be positive")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    names = [f"_x{i}" for i in range(len(features))]
    rows = train.select(*[F.col(f).cast("double").alias(x) for f, x in zip(features, names)],
                        F.col(label).cast("double").alias("_y"), w.alias("_w"))
    rows = cut_lineage(rows.dropna())
    if not rows.where(~F.col("_y").isin(0.0, 1.0)).isEmpty():
        raise ValueError("labels must be 0 or 1")
    penalty = np.append(np.full(len(names), 1.0 / c), 0.0)
    beta = np.zeros(len(names) + 1)

    def at(b):
        loss, gradient, hessian = _at(rows, len(b), b)
        return loss + (penalty * b * b).sum() / 2, gradient + penalty * b, hessian + np.diag(penalty)

    loss, gradient, hessian = at(beta)
    for step in range(1, max_steps + 1):
        # One class only leaves the intercept without a curvature at last: a least-squares solution stays finite.
        move = np.linalg.lstsq(hessian, -gradient, rcond=1e-15)[0]
        for _ in range(HALVINGS):
            new = at(beta + move)
            if new[0] <= loss + 1e-12 * abs(loss):
                break
            move = move / 2
        beta, (loss, gradient, hessian) = beta + move, new
        if (np.abs(move) <= tol * np.maximum(1.0, np.abs(beta))).all():
            break
    return LogisticFit(beta[:-1].tolist(), float(beta[-1]), float(loss), step)
