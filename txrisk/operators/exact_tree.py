"""M2 and M4 with exact splits: binary gini trees whose thresholds are searched over all
distinct values (the library's rule), not over bins.

Level by level: the rows of all open nodes become (node, feature, value) counts
of both classes, combined map-side; they are range-partitioned, class counts
below every value are accumulated per partition and offset by the partitions
before it (``metrics.below``), and each node keeps its best split. Nodes of a
level, at most 2^depth a tree, reach the driver. Rows are written once, with their
counts in the trees, and walk from their roots by projections (their places are
written every few levels); the last level, which is not split, is one count a node.

A forest grows all its trees at once: tree ``t`` starts at node ``first + t`` with
``first`` the next power of two, so that children ``2 i`` and ``2 i + 1`` never meet
those of another tree and a level of the whole forest is one aggregation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import json_lit, safe_div, uniform
from ..session import cut_lineage
from .metrics import below

MOST_DEPTH = 12             # of an exact tree: its nodes are driver values
PLACES = 9                  # gains are compared at this many places, ties go to the first feature, then the lower threshold
WALKED = 3                  # levels that rows walk again, at most, before their places are written
SCHEMA = ("node bigint, depth int, feature string, threshold double, n bigint, positives bigint, "
          "impurity double, gain double")


def _gini(pos: Column, neg: Column) -> Column:
    share = safe_div(pos, pos + neg)
    return 2.0 * share * (1.0 - share)


def _child(features: Sequence[str], splits: list) -> Column:
    """Child of a row whose node was split, NULL in a leaf."""
    names, out = list(features), F.lit(None).cast("bigint")
    for s in splits:
        x = F.col(f"_x{names.index(s['feature'])}")
        out = F.when(F.col("_node") == s["node"], F.when(x <= s["threshold"], 2 * s["node"]).otherwise(2 * s["node"] + 1)) \
            .otherwise(out)
    return out


def _roots(rows: DataFrame, first: int) -> DataFrame:
    """A row for every tree that a row stands in, at the tree's root (``_node, _y, _xs, _m``)."""
    return rows.select("_y", "_xs", F.posexplode("_m").alias("_t", "_m")).where(F.col("_m") > 0) \
        .select((F.col("_t") + F.lit(first)).cast("bigint").alias("_node"), "_y", "_xs", "_m")


def _walked(at: DataFrame, levels: Sequence[list]) -> DataFrame:
    """Rows moved down by the splits of the ``levels``; those in a leaf are left out."""
    for splits in levels:
        lowest = min(s[0] for s in splits)
        cuts = {node - lowest: {"f": f, "t": t} for node, f, t in splits}
        table = json_lit([cuts.get(i) for i in range(max(cuts) + 1)], "array<struct<f:int,t:double>>")
        at = at.withColumn("_s", F.get(table, (F.col("_node") - lowest).cast("int"))).where(F.col("_s").isNotNull()) \
            .select((2 * F.col("_node") + (F.get("_xs", F.col("_s.f")) > F.col("_s.t")).cast("bigint")).alias("_node"),
                    "_y", "_xs", "_m")
    return at


def _sums() -> tuple[Column, Column]:
    return F.sum(F.col("_m") * F.col("_y")), F.sum(F.col("_m") * (1 - F.col("_y")))


def level_nodes(rows: DataFrame, weights: tuple[float, float]) -> DataFrame:
    """The nodes of the last level, which are not split, from ``_node, _y, _m``."""
    pos, neg = _sums()
    return _table(rows.groupBy("_node").agg(pos.alias("P"), neg.alias("N")), weights, F.lit(None).cast("string"),
                  *2 * [F.lit(None).cast("double")])


def _table(nodes: DataFrame, weights: tuple[float, float], feature: Column, threshold: Column, gain: Column) -> DataFrame:
    return nodes.select(F.col("_node").alias("node"), feature.alias("feature"), threshold.alias("threshold"),
                        (F.col("P") + F.col("N")).alias("n"), F.col("P").alias("positives"),
                        _gini(F.col("P") * weights[1], F.col("N") * weights[0]).alias("impurity"), gain.alias("gain"))


def level_splits(rows: DataFrame, features: Sequence[str], weights: tuple[float, float], min_leaf: int,
                 tried: dict[int, list[int]] | None = None) -> DataFrame:
    """Best split of every node of ``rows`` (``_node, _y, _xs, _m``: a row counts ``_m``
    times) among all features, or those ``tried`` there; nodes that are pure or can't be
    split have a NULL feature."""
    w0, w1 = weights
    if tried is None:
        long = rows.select("_node", "_y", "_m", F.posexplode("_xs").alias("_f", "s"))
    else:
        lowest = min(tried)
        here = json_lit([tried.get(i) for i in range(lowest, max(tried) + 1)], "array<array<int>>")
        long = rows.select("_node", "_y", "_m", "_xs", F.explode(F.get(here, (F.col("_node") - lowest).cast("int"))).alias("_f")) \
            .select("_node", "_y", "_m", "_f", F.get("_xs", F.col("_f")).alias("s"))
    pos, neg = _sums()
    counts = long.groupBy("_node", "_f", "s").agg(pos.alias("pos"), neg.alias("neg"))
    cuts = below(counts, by=["_node", "_f"])
    pos, neg = F.col("pos_below") * w1, F.col("neg_below") * w0
    all_pos, all_neg = F.col("all_pos") * w1, F.col("all_neg") * w0
    total, left = all_pos + all_neg, pos + neg
    gain = _gini(all_pos, all_neg) - safe_div(left, total) * _gini(pos, neg) \
        - safe_div(total - left, total) * _gini(all_pos - pos, all_neg - neg)
    n_left = F.col("pos_below") + F.col("neg_below")
    fine = F.col("low_s").isNotNull() & (n_left >= min_leaf) & (F.col("all_pos") + F.col("all_neg") - n_left >= min_leaf)
    middle = (F.col("low_s") + F.col("s")) / 2
    tries = cuts.select("_node", "all_pos", "all_neg", F.when(fine, F.round(gain, PLACES)).alias("g"), "_f", middle.alias("t"))
    split = F.when(F.col("g") > 0, F.struct("g", (-F.col("_f")).alias("f"), (-F.col("t")).alias("t")))
    # Every feature of a node holds all its rows.
    nodes = tries.groupBy("_node").agg(F.max("all_pos").alias("P"), F.max("all_neg").alias("N"), F.max(split).alias("b"))
    names = F.array(*[F.lit(c) for c in features])
    return _table(nodes, weights, F.when(F.col("b").isNotNull(), F.get(names, -F.col("b.f"))), -F.col("b.t"), F.col("b.g"))


def fit_exact_tree(train: DataFrame, features: Sequence[str], label: str = "label", depth: int = 3,
                   weights: tuple[float, float] = (1.0, 1.0), min_leaf: int = 1) -> DataFrame:
    """Node table of the tree: root 1, children ``2 i`` (value <= threshold) and
    ``2 i + 1``; leaves have no feature.

    ``weights`` are those of class 0 and 1. Rows with a NULL label or feature are
    left out; labels are 0 and 1. An empty table gives no node.
    """
    _check_depth(depth)
    rows = cut_lineage(_plain_rows(train, features, label, F.array(F.lit(1))))
    return _grow(rows, features, depth, weights, min_leaf, [1])


def fit_exact_forest(train: DataFrame, features: Sequence[str], label: str = "label", trees: int = 10, depth: int = 3,
                     weights: tuple[float, float] = (1.0, 1.0), min_leaf: int = 1, per_split: int | None = None,
                     key: str = "row_key", seed: int = 42) -> DataFrame:
    """Node table of a forest: roots (depth 0) are ``first`` to ``first + trees - 1``.

    A row stands in a tree as often as a Poisson draw of mean 1 from its key and
    the tree says (the bootstrap sample); every node tries the ``per_split`` features
    (default: the square root of their number) that come first by digest. A tree
    whose sample is empty has no node. NULLs and labels as in ``fit_exact_tree``.
    """
    _check_depth(depth)
    d = len(features)
    per_split = per_split or max(1, math.isqrt(d))
    if trees < 1 or not 1 <= per_split <= d:
        raise ValueError("a forest needs a tree, and 1 to all features a split")
    first = first_root(trees)
    steps = poisson_steps()

    # A digest a row and tree, compared with all steps; a row is written once with its counts.
    draws = F.array(*[uniform(key, seed, f"tree{t}") for t in range(trees)])
    times = F.transform(draws, lambda u: F.size(F.filter(F.lit(steps), lambda c: c <= u)))
    rows = cut_lineage(_plain_rows(train, features, label, times))
    return _grow(rows, features, depth, weights, min_leaf, list(range(first, first + trees)), (per_split, seed))


def first_root(trees: int) -> int:
    """The next power of two: no node of one tree is a descendant of another's."""
    return 1 << (trees - 1).bit_length()


def poisson_steps(mean: float = 1.0) -> list[float]:
    """Cumulative Poisson probabilities: a uniform draw counts the steps up to it."""
    out, p, k = [], math.exp(-mean), 0
    total = p
    while total < 1 - 2.0 ** -32:           # draws have 32 bits
        out.append(total)
        k += 1
        p *= mean / k
        total += p
    return out


def tried_features(node: int, d: int, per_split: int, seed: int) -> list[int]:
    """The first ``per_split`` of ``d`` features in the node's digest order."""
    return sorted(range(d), key=lambda f: (md5(f"{node}:{f}:{seed}".encode()).hexdigest(), f))[:per_split]


def _check_depth(depth: int) -> None:
    if not 0 <= depth <= MOST_DEPTH:
        raise ValueError(f"depth must be 0 to {MOST_DEPTH}")


def _plain_rows(train: DataFrame, features: Sequence[str], label: str, times: Column) -> DataFrame:
    """``_y, _xs`` and ``_m``, how often the row stands in each tree."""
    known = train.where(F.col(label).isNotNull())
    for c in features:
        known = known.where(F.col(c).cast("double").isNotNull())
    return known.select(F.col(label).cast("bigint").alias("_y"), F.array(*[F.col(c).cast("double") for c in features]).alias("_xs"),
                        times.alias("_m"))


def _grow(rows: DataFrame, features: Sequence[str], depth: int, weights: tuple[float, float], min_leaf: int,
          roots: list[int], subset: tuple[int, int] | None = None) -> DataFrame:
    """Node table from rows and their counts in the trees, level by level."""
    names, done, levels, open_nodes = list(features), [], [], roots
    start = _roots(rows, roots[0])
    for level in range(depth + 1):
        if len(levels) > WALKED:
            start, levels = cut_lineage(_walked(start, levels)), []
        at = _walked(start, levels)
        if level == depth:
            found = level_nodes(at, weights).collect()
        else:
            tried = subset and {n: tried_features(n, len(names), *subset) for n in open_nodes}
            found = level_splits(at, features, weights, min_leaf, tried).collect()      # at most 2^level rows a tree
        done += [(r["node"], level, r["feature"], r["threshold"], r["n"], r["positives"], r["impurity"], r["gain"]) for r in found]
        splits = [(r["node"], names.index(r["feature"]), r["threshold"]) for r in found if r["feature"] is not None]
        if not splits:
            break
        levels.append(splits)
        open_nodes = [c for node, _, _ in splits for c in (2 * node, 2 * node + 1)]
    return rows.sparkSession.createDataFrame(done, SCHEMA)


def predict_exact_tree(nodes: DataFrame, df: DataFrame, features: Sequence[str],
                       weights: tuple[float, float] = (1.0, 1.0)) -> DataFrame:
    """``df`` plus ``score`` (weighted share of class 1 in the row's leaf, the mean
    over the trees of a forest) and ``prediction``."""
    w0, w1 = weights
    table = {r["node"]: r for r in nodes.collect()}
    roots = sorted(n for n, r in table.items() if r["depth"] == 0)
    if not roots:
        raise ValueError("the tree was fitted without a row")

    def at(node: int) -> Column:
        r = table[node]
        if r["feature"] is None or 2 * node not in table:
            pos, neg = r["positives"] * w1, (r["n"] - r["positives"]) * w0
            return F.lit(pos / (pos + neg) if pos + neg else 0.0)
        return F.when(F.col(r["feature"]).cast("double") <= r["threshold"], at(2 * node)).otherwise(at(2 * node + 1))

    score = sum((at(r) for r in roots[1:]), at(roots[0])) / float(len(roots))
    return df.withColumn("score", score).withColumn("prediction", (F.col("score") > 0.5).cast("int"))


def exact_importances(nodes: DataFrame, features: Sequence[str], top_n: int | None = None,
                      weights: tuple[float, float] = (1.0, 1.0)) -> DataFrame:
    """M12 + K2: gain times weighted rows of a feature's splits, as shares of each
    tree, their mean over the trees that split, best first (ties by name). A feature
    never split on has 0, and so have all without a split."""
    w0, w1 = weights
    rows = F.col("positives") * w1 + (F.col("n") - F.col("positives")) * w0
    root = F.expr("shiftright(node, depth)")
    by = nodes.where(F.col("feature").isNotNull()).groupBy(root.alias("_tree"), "feature").agg(F.sum(F.col("gain") * rows).alias("_v"))
    share = by.withColumn("_v", F.col("_v") / F.sum("_v").over(Window.partitionBy("_tree"))) \
        .groupBy("feature").agg(F.sum("_v").alias("_v"))
    share = share.withColumn("_v", F.col("_v") / F.sum("_v").over(Window.partitionBy(F.lit(0))))      # a row a feature
    names = nodes.sparkSession.createDataFrame([(c,) for c in features], "feature string")
    out = names.join(share, "feature", "left").select("feature", F.coalesce("_v", F.lit(0.0)).alias("importance")) \
        .orderBy(F.col("importance").desc(), "feature")
    return out if top_n is None else out.limit(top_n)
