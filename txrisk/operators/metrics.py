"""Classification metrics from one confusion aggregation.

``confusion`` reads the predictions once (``groupBy(label, prediction)``, a
partial aggregation) and keeps that small table; the class grid and every
metric come from it. ROC and AUC aggregate once by distinct score and
accumulate counts over range partitions of the scores, so a window holds one
partition of scores, whatever their number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import safe_div
from ..session import cut_lineage

AVERAGES = ("binary", "macro", "weighted", "micro")
F1_MODES = ("per_class", "of_averages")


def _check_average(average: str):
    if average not in AVERAGES:
        raise ValueError(f"unknown average {average!r}: choose one of {', '.join(AVERAGES)}")


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction",
              labels: Sequence | None = None) -> DataFrame:
    """Dense (label, prediction, count) over ``classes x classes``; the
    grid is made on the executors from the counted classes. With ``labels``
    (hand-written semantics, T20) an unseen class is an error."""
    counts = cut_lineage(pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
                         .agg(F.count(F.lit(1)).alias("count")))
    kind = pred.schema[label].dataType.simpleString()
    both = F.array_union(F.collect_set("label"), F.collect_set(F.col("prediction").cast(kind)))
    if labels is not None:
        known = F.lit(list(labels)).cast(f"array<{kind}>")
        extra = counts.select(F.explode(F.array("label", F.col("prediction").cast(kind))).alias("c")) \
            .where(F.col("c").isNotNull() & ~F.array_contains(known, F.col("c"))).distinct().limit(5).collect()
        if extra:
            raise ValueError(f"classes {sorted(r['c'] for r in extra)} were not among the training classes")
        both = F.max(known)
    grid = counts.agg(both.alias("classes")).select(F.explode("classes").alias("label"), "classes") \
        .select("label", F.explode("classes").alias("prediction"))
    return (grid.join(counts, ["label", "prediction"], "left")
            .select("label", "prediction", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def per_class(conf: DataFrame) -> DataFrame:
    """Label, tp, fp, fn, precision, recall, f1, support (zero
    denominators give 0.0, T21)."""
    rows = conf.select(F.col("label").alias("c"), "count", (F.col("label") == F.col("prediction")).alias("hit"),
                       F.lit("row").alias("role"))
    cols = conf.select(F.col("prediction").alias("c"), "count", F.lit(False).alias("hit"), F.lit("col").alias("role"))
    g = rows.unionByName(cols).groupBy(F.col("c").alias("label")).agg(
        F.sum(F.when(F.col("hit"), F.col("count")).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.when(F.col("role") == "col", F.col("count")).otherwise(0)).cast("bigint").alias("predicted"),
        F.sum(F.when(F.col("role") == "row", F.col("count")).otherwise(0)).cast("bigint").alias("support"))
    p = safe_div(F.col("tp"), F.col("predicted"))
    r = safe_div(F.col("tp"), F.col("support"))
    out = g.select("label", "tp", (F.col("predicted") - F.col("tp")).alias("fp"),
                   (F.col("support") - F.col("tp")).alias("fn"), p.alias("precision"), r.alias("recall"),
                   "support")
    f1 = safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return out.withColumn("f1", f1).select("label", "tp", "fp", "fn", "precision", "recall", "f1", "support")


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """A16."""
    return pred.agg(F.avg(F.coalesce(F.col(label) == F.col(prediction), F.lit(False)).cast("double"))
                    .alias("accuracy"))


def _avg_expr(metric: str, average: str, pos_label=None):
    """Aggregate expression over the per-class table for one average."""
    _check_average(average)
    if average == "binary":
        if pos_label is None:
            return F.max_by(F.col(metric), F.col("label"))
        return F.max(F.when(F.col("label") == F.lit(pos_label), F.col(metric)))
    if average == "macro":
        return F.avg(metric)
    if average == "weighted":
        return safe_div(F.sum(F.col(metric) * F.col("support")), F.sum("support"))
    other = {"precision": "fp", "recall": "fn"}[metric]
    return safe_div(F.sum("tp"), F.sum("tp") + F.sum(other))


def _f1_expr(average: str, mode: str = "per_class", pos_label=None):
    if mode not in F1_MODES:
        raise ValueError(f"mode must be one of {F1_MODES}")
    if mode == "per_class" and average in ("binary", "macro", "weighted"):
        return _avg_expr("f1", average, pos_label)
    p = _avg_expr("precision", average, pos_label)
    r = _avg_expr("recall", average, pos_label)
    return safe_div(2 * p * r, p + r)


def averaged(pc: DataFrame, metric: str, average: str, pos_label=None) -> DataFrame:
    """A17/A18 over the per-class table: binary (positive = ``pos_label``,
    default the largest class, T19), macro, weighted, micro. One row."""
    return pc.agg(_avg_expr(metric, average, pos_label).alias(metric))


def metric_modes(pc: DataFrame, metric: str, pos_label=None) -> DataFrame:
    """(average, metric) for the four averages, one aggregation."""
    wide = pc.agg(*[_avg_expr(metric, a, pos_label).alias(a) for a in AVERAGES])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("average"), F.col(a).alias(metric)) for a in AVERAGES])).alias("e")).select("e.*")


def f1(pc: DataFrame, average: str, mode: str = "per_class", pos_label=None) -> DataFrame:
    """A19. ``per_class``: library F1 (mean / weighted mean of per-class F1,
    micro from micro P and R); ``of_averages``: harmonic mean of the averaged
    precision and recall (hand-written, T17)."""
    _check_average(average)
    return pc.agg(_f1_expr(average, mode, pos_label).alias("f1"))


def f1_modes(pc: DataFrame, mode: str = "per_class", pos_label=None) -> DataFrame:
    wide = pc.agg(*[_f1_expr(a, mode, pos_label).alias(a) for a in AVERAGES])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("average"), F.col(a).alias("f1")) for a in AVERAGES])).alias("e")).select("e.*")


# ----------------------------------------------------------------- ROC / AUC
def _score_table(pred: DataFrame, label: str, score: str, pos_label) -> DataFrame:
    """Distinct scores with positive and negative counts (hot scores are
    combined map-side)."""
    y = F.coalesce(F.col(label) == F.lit(pos_label), F.lit(False)).cast("bigint")
    return (pred.where(F.col(score).isNotNull())
            .select(F.col(score).cast("double").alias("s"), y.alias("y"))
            .groupBy("s").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    """Null-safe equality of key columns of two frames."""
    cond = F.lit(True)
    for c in keys:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def below(st: DataFrame, partitions: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score (of a group ``by``), the positives and negatives
    strictly below it, all of the group (``all_pos, all_neg``), and the next lower score with its
    counts (``low_s, low_pos, low_neg``, NULL at the lowest). The scores are range-partitioned; each partition is
    accumulated by itself, offset by the totals of the partitions before it and
    given the last row of the one before it (one row a partition and group)."""
    by = list(by)
    dealt = st.repartitionByRange(partitions, *by, "s") if partitions else st.repartitionByRange(*by, "s")
    b = cut_lineage(dealt.withColumn("_b", F.spark_partition_id()))
    bt = b.groupBy(*by, "_b").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"),
                                  F.max_by(F.struct("pos", "neg", "s"), "s").alias("_last"))
    order = Window.partitionBy(*by).orderBy("_b") if by else Window.orderBy("_b")
    prev = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bt = bt.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col("_b").alias("_of"),
                   F.coalesce(F.sum("_bp").over(prev), F.lit(0)).alias("_op"),
                   F.coalesce(F.sum("_bn").over(prev), F.lit(0)).alias("_on"), F.lag("_last").over(order).alias("_last"),
                   F.sum("_bp").over(whole).alias("all_pos"), F.sum("_bn").over(whole).alias("all_neg"))
    same = F.col("_b") == F.col("_of")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    inside = Window.partitionBy("_b", *by).orderBy("s")
    w = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (b.join(bt, same)
            .select(*by, "s", "pos", "neg", "all_pos", "all_neg",
                    (F.col("_op") + F.coalesce(F.sum("pos").over(w), F.lit(0))).alias("pos_below"),
                    (F.col("_on") + F.coalesce(F.sum("neg").over(w), F.lit(0))).alias("neg_below"),
                    F.coalesce(F.lag("pos").over(inside), F.col("_last.pos")).alias("low_pos"),
                    F.coalesce(F.lag("neg").over(inside), F.col("_last.neg")).alias("low_neg"),
                    F.coalesce(F.lag("s").over(inside), F.col("_last.s")).alias("low_s")))


_below = below


def _auc(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    return table.groupBy(*by).agg(F.try_divide(F.sum(pos * (F.col("neg_below").cast("double") + 0.5 * neg)),
                                               F.sum(pos) * F.sum(neg)).alias("roc_auc"))


def roc_auc(pred: DataFrame, label: str = "label", score: str = "score", pos_label=1,
            partitions: int | None = None) -> DataFrame:
    """Exact AUC with ties counted half (Mann-Whitney); NULL when only one
    class is present (T22). Products are doubles: counts do not overflow."""
    return _auc(below(_score_table(pred, label, score, pos_label), partitions))


DROPS = (None, "equal_steps", "collinear")


def roc_points(pred: DataFrame, label: str = "label", score: str = "score", pos_label=1,
               partitions: int | None = None, drop: str | None = None) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, plus the (0, 0)
    start at threshold +inf.

    ``drop`` leaves points out whose step from the point before and step to the
    point after make no corner: ``equal_steps`` (the library's rule: both steps
    add the same counts) or ``collinear`` (both have one slope, compared exactly
    by cross products). The start, the highest and the lowest score stay.
    """
    if drop not in DROPS:
        raise ValueError(f"drop must be one of {DROPS}")
    b = cut_lineage(below(_score_table(pred, label, score, pos_label), partitions))
    tot = b.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    P, N = F.lit(tot["P"] or 0), F.lit(tot["N"] or 0)
    kept = b
    if drop:
        pos, neg, low_pos, low_neg = (F.col(c).cast("decimal(19,0)") for c in ("pos", "neg", "low_pos", "low_neg"))
        straight = (pos == low_pos) & (neg == low_neg) if drop == "equal_steps" else pos * low_neg == neg * low_pos
        top = (F.col("pos_below") + F.col("pos") == P) & (F.col("neg_below") + F.col("neg") == N)
        kept = b.where(top | F.col("low_pos").isNull() | ~straight)
    pts = kept.select(F.col("s").alias("threshold"),
                      F.try_divide(N - F.col("neg_below"), N).alias("fpr"),
                      F.try_divide(P - F.col("pos_below"), P).alias("tpr"))
    start = b.limit(1).select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                              F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def auc_value(pred: DataFrame, label: str = "label", score: str = "score", pos_label=1) -> float | None:
    return roc_auc(pred, label, score, pos_label).first()["roc_auc"]


def report_row(pred: DataFrame, label: str = "label", prediction: str = "prediction",
               score: str | None = "score", pos_label=None) -> DataFrame:
    """Accuracy, precision, recall, f1 (binary) and roc_auc (NULL
    without scores or with one class, T22). Two scans of the predictions: the
    confusion counts and the distinct scores."""
    pc = cut_lineage(per_class(confusion(pred, label, prediction)))
    auc = None
    if score is not None:
        pos = pos_label if pos_label is not None else pc.agg(F.max("label")).first()[0]
        auc = auc_value(pred, label, score, pos)
    return pc.agg(
        safe_div(F.sum("tp"), F.sum("support")).alias("accuracy"),
        _avg_expr("precision", "binary", pos_label).alias("precision"),
        _avg_expr("recall", "binary", pos_label).alias("recall"),
        _avg_expr("f1", "binary", pos_label).alias("f1"),
        F.lit(auc).cast("double").alias("roc_auc"))


def report_rows(pred: DataFrame, by: str | Sequence[str], label: str = "label", prediction: str = "prediction",
                score: str | None = "score", pos_label=1, partitions: int | None = None) -> DataFrame:
    """A22 per group (a model, a segment): the ``by`` columns, support,
    accuracy, precision, recall, f1 (of ``pos_label``) and roc_auc (NULL without
    scores or with one class). NULL group keys are a group.

    The predictions are aggregated once, by (group, label, prediction, score);
    the confusion counts and the score table both come from those cells. Scores
    of all groups are accumulated in one pass over ranges of (group, score).
    """
    names = [by] if isinstance(by, str) else list(by)
    by = [f"_g{i}" for i in range(len(names))]
    s = F.col(score).cast("double") if score is not None else F.lit(None).cast("double")
    keys = [F.col(c).alias(g) for c, g in zip(names, by)]
    cells = cut_lineage(pred.select(*keys, F.col(label).alias("label"), F.col(prediction).alias("prediction"), s.alias("s"))
                        .groupBy(*by, "label", "prediction", "s").agg(F.count(F.lit(1)).alias("n")))
    n = F.col("n")
    hit = F.coalesce(F.col("label") == F.col("prediction"), F.lit(False))
    real = F.coalesce(F.col("label") == F.lit(pos_label), F.lit(False))
    said = F.coalesce(F.col("prediction") == F.lit(pos_label), F.lit(False))

    def total(cond):
        return F.sum(F.when(cond, n).otherwise(0))

    p, r = F.col("precision"), F.col("recall")
    table = cells.groupBy(*by).agg(
        F.sum(n).alias("support"), safe_div(total(hit), F.sum(n)).alias("accuracy"),
        safe_div(total(real & said), total(said)).alias("precision"),
        safe_div(total(real & said), total(real)).alias("recall")) \
        .withColumn("f1", safe_div(2 * p * r, p + r))
    scores = cells.where(F.col("s").isNotNull()).groupBy(*by, "s") \
        .agg(total(real).alias("pos"), total(~real).alias("neg"))
    auc = _auc(below(scores, partitions, by), by)
    measures = ["support", "accuracy", "precision", "recall", "f1", "roc_auc"]
    return table.join(auc, _same(table, auc, by), "left") \
        .select(*[table[g].alias(c) for c, g in zip(names, by)], *measures)


def class_report(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                 names: dict | None = None) -> DataFrame:
    """Per-class rows, then accuracy, macro avg, weighted avg."""
    pc = cut_lineage(per_class(confusion(pred, label, prediction)))
    name = F.col("label").cast("string")
    if names:
        m = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
        name = F.coalesce(F.try_element_at(m, F.col("label")), name)
    rows = pc.select(name.alias("row"), "precision", "recall", "f1", "support")
    tot = pc.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                 F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                 safe_div(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("wp"),
                 safe_div(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("wr"),
                 safe_div(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), safe_div(F.col("tp"), F.col("n")).alias("f1"),
                     F.col("n").cast("bigint").alias("support"))
    mac = tot.select(F.lit("macro avg").alias("row"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                     F.col("mf").alias("f1"), F.col("n").cast("bigint").alias("support"))
    wei = tot.select(F.lit("weighted avg").alias("row"), F.col("wp").alias("precision"),
                     F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").cast("bigint").alias("support"))
    return rows.unionByName(acc).unionByName(mac).unionByName(wei)
