"""M5 by aggregations: boosted trees by second-order (Newton) steps with exact splits.

A round takes every row's gradient and curvature of the weighted logistic loss
at its margin and grows one tree: per level, (node, feature, value) sums are
combined map-side, range-partitioned and accumulated per partition
(``metrics.below``), and each node keeps the split of the largest gain
``GL^2/(HL+lam) + GR^2/(HR+lam) - G^2/(H+lam)``. Splits, at most 2^depth a tree,
reach the driver; rows find their leaf by a projection and are written once a round.

Gradients and curvatures are summed as fixed-point integers, so a tree is the
same whatever the partitioning. Their scale leaves room for the total weight.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .exact_tree import PLACES, _check_depth, _child
from .metrics import below
from .newton import logistic

SCALE_BITS = 30             # of the fixed-point sums, fewer beyond 2^31 of total weight
SCHEMA = ("tree int, node bigint, depth int, feature string, threshold double, gain double, "
          "weight double, value double")


def scale_for(total: float) -> float:
    """Largest power of two up to 2^30 with which ``total`` stays below 2^62."""
    return 2.0 ** min(SCALE_BITS, 62 - math.ceil(math.log2(max(total, 1.0))))


def _fixed(x: Column, scale: float) -> Column:
    return F.round(x * F.lit(scale)).cast("bigint")


def _splits(rows: DataFrame, features: Sequence[str], open_nodes: list[int], scale: float, total: float, lam: float,
            min_child: float) -> dict[int, dict]:
    """Sums of the open nodes (``G``, ``H``) and their best splits, where one gains."""
    here = rows.where(F.col("_node").isin(open_nodes))
    nodes = here.groupBy("_node").agg(F.sum("_g").alias("G"), F.sum("_h").alias("H"))
    xs = F.array(*[F.col(f"_x{i}") for i in range(len(features))])
    sums = here.select("_node", "_g", "_h", F.posexplode(xs).alias("_f", "s")).groupBy("_node", "_f", "s") \
        .agg(F.sum("_g").alias("pos"), F.sum("_h").alias("neg"))
    cuts = below(sums, by=["_node", "_f"]).where(F.col("low_s").isNotNull()).join(nodes, "_node")

    def real(c: str) -> Column:
        return F.col(c).cast("double") / F.lit(scale)

    gl, hl, g, h = real("pos_below"), real("neg_below"), real("G"), real("H")
    gain = gl * gl / (hl + lam) + (g - gl) * (g - gl) / (h - hl + lam) - g * g / (h + lam)
    best = cuts.where((hl >= min_child) & (h - hl >= min_child)) \
        .select("_node", F.round(gain / F.lit(total), PLACES).alias("gain"), "_f", ((F.col("low_s") + F.col("s")) / 2).alias("t")) \
        .where(F.col("gain") > 0).groupBy("_node") \
        .agg(F.max(F.struct("gain", (-F.col("_f")).alias("f"), (-F.col("t")).alias("t"))).alias("b")) \
        .select(F.col("_node").alias("_of"), "b")
    out = {}
    for r in nodes.join(best, F.col("_node") == F.col("_of"), "left").collect():        # at most 2^level rows
        b = r["b"]
        out[r["_node"]] = {"node": r["_node"], "G": r["G"], "H": r["H"], "feature": b and features[-b["f"]],
                           "threshold": b and -b["t"], "gain": b and b["gain"]}
    return out


def fit_newton_boosting(train: DataFrame, features: Sequence[str], label: str = "label", rounds: int = 200, depth: int = 6,
                        rate: float = 0.1, pos_weight: float = 1.0, lam: float = 1.0, min_child: float = 1.0) -> DataFrame:
    """Node table: per tree root 1, children ``2 i`` (value <= threshold) and
    ``2 i + 1``; ``value`` (leaves only) is what a leaf adds to the margin, ``gain`` the
    split's gain over the total weight, ``weight`` the node's curvature.

    Margins start at 0. Rows of class 1 weigh ``pos_weight``. A split needs a gain
    that is positive at 9 places and ``min_child`` curvature on both sides; ties go to the first
    feature, then the lower threshold. Rows with a NULL label or feature are left out;
    other labels than 0 and 1 are an error; an empty table gives no node.
    """
    _check_depth(depth)
    if rounds < 1 or rate <= 0 or pos_weight <= 0 or lam <= 0 or min_child < 0:
        raise ValueError("rounds, rate, pos_weight and lam must be positive, min_child not negative")
    spark, n = train.sparkSession, len(features)
    y = F.col(label).cast("double")
    rows = cut_lineage(train.select(
        y.alias("_y"), F.when(y == 1, F.lit(float(pos_weight))).otherwise(1.0).alias("_w"), F.lit(0.0).alias("_m"),
        *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)]).dropna())
    if not rows.where(~F.col("_y").isin(0.0, 1.0)).isEmpty():
        raise ValueError("labels must be 0 or 1")
    total = rows.agg(F.sum("_w")).first()[0]
    if total is None:
        return spark.createDataFrame([], SCHEMA)
    scale, done = scale_for(total), []
    for tree in range(rounds):
        p = F.col("_p")
        at = rows.withColumn("_p", logistic(F.col("_m"))).select(
            "*", _fixed(F.col("_w") * (p - F.col("_y")), scale).alias("_g"), _fixed(F.col("_w") * p * (1.0 - p), scale).alias("_h"),
            F.lit(1).cast("bigint").alias("_node"))
        open_nodes, leaves = [1], {}
        for level in range(depth + 1):
            if level < depth:
                found = _splits(at, features, open_nodes, scale, total, lam, min_child)
            else:
                found = {r["_node"]: {**r.asDict(), "feature": None, "threshold": None, "gain": None} for r in
                         at.where(F.col("_node").isin(open_nodes)).groupBy("_node")
                         .agg(F.sum("_g").alias("G"), F.sum("_h").alias("H")).collect()}
            for node, r in found.items():
                value = None if r["feature"] else -rate * (r["G"] / scale) / (r["H"] / scale + lam)
                if value is not None:
                    leaves[node] = value
                done.append((tree, node, level, r["feature"], r["threshold"], r["gain"], r["H"] / scale, value))
            splits = [r for r in found.values() if r["feature"]]
            if not splits:
                break
            open_nodes = [c for r in splits for c in (2 * r["node"], 2 * r["node"] + 1)]
            at = at.withColumn("_node", F.coalesce(_child(features, splits), F.col("_node")))
        step = F.element_at(F.create_map(*[x for k, v in leaves.items() for x in (F.lit(k).cast("bigint"), F.lit(v))]), F.col("_node"))
        rows = cut_lineage(at.select("_y", "_w", (F.col("_m") + step).alias("_m"), *[f"_x{i}" for i in range(n)]))
    return spark.createDataFrame(done, SCHEMA)


def predict_newton_boosting(nodes: DataFrame, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``df`` plus ``score`` = P(1) and ``prediction``; both NULL where a feature is
    NULL or NaN. Rows walk the trees in Arrow batches (the node table is the model, a
    driver value of at most 2^(depth + 1) nodes a tree)."""
    names, trees = list(features), {}
    for r in nodes.collect():
        trees.setdefault(r["tree"], {})[r["node"]] = r
    if not trees:
        raise ValueError("the trees were fitted without a row")
    tables = []
    for t in sorted(trees):
        ids = np.array(sorted(trees[t]))
        rs = [trees[t][i] for i in ids.tolist()]
        tables.append((max(r["depth"] for r in rs), ids, np.array([names.index(r["feature"]) if r["feature"] else -1 for r in rs]),
                       np.array([r["threshold"] or 0.0 for r in rs]), np.array([r["value"] or 0.0 for r in rs])))
    kept = df.drop("score", "prediction")
    out, columns = T.StructType([*kept.schema.fields, T.StructField("_margin", T.DoubleType())]), [*kept.columns, "_margin"]

    def walk(it):
        for b in it:
            cols = b.columns[:-len(names)]
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns[-len(names):]]).astype(float)
            margin = np.zeros(b.num_rows)
            for deep, ids, feature, cut, value in tables:
                at = np.ones(b.num_rows, np.int64)
                for _ in range(deep):
                    k = np.searchsorted(ids, at)
                    f = feature[k]
                    right = x[np.arange(len(x)), np.maximum(f, 0)] > cut[k]
                    at = np.where(f < 0, at, 2 * at + right)
                margin += value[np.searchsorted(ids, at)]
            unknown = np.isnan(x).any(axis=1)
            yield pa.RecordBatch.from_arrays([*cols, pa.array(margin, mask=unknown)], names=columns)

    given = kept.select("*", *[F.col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(names)])
    score = F.when(F.col("_margin").isNotNull(), logistic(F.col("_margin")))
    return given.mapInArrow(walk, out).withColumn("score", score) \
        .withColumn("prediction", (F.col("score") > 0.5).cast("int")).drop("_margin")
