"""The query registry: every operator of the inventory as a Spark plan over
the driver's tables, plus (where SQL can express it) its DuckDB twin.

Naming follows the inventory: ``shape`` S5, ``fraud_by_type`` A6, ...
Computed doubles are rounded to 6 places on both sides (T32).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import r6
from ..functions.quantile import exact_percentile_value
from ..operators import boosting as bo
from ..operators import ensemble as en
from ..operators import exact_tree as et
from ..operators import estimators as es
from ..operators import features as fe
from ..operators import knn as kn
from ..operators import metrics as me
from ..operators import models as mo
from ..operators import quality as qu
from ..operators import sampling as sa
from ..operators import scaling as sc
from ..operators import stats as st
from ..operators.smote import balance, smote
from ..operators.stats import with_weights
from ..schema import FEATURE_COLS, KEY, LABEL, MANAGER_FEATURE_COLS, RISK_NAMES
from ..session import cut_lineage
from ..sources import transactions as src
from . import fitted as ft
from . import pipeline as pl
from . import sql as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


SOURCE_COLS = S.SOURCE_COLS


def _feat(spark, sf_dir, dirty: bool = False) -> DataFrame:
    tx = src.load_tx_dirty(spark, sf_dir) if dirty else src.load_tx(spark, sf_dir)
    return fe.feature_table(tx, fe.fit_type_codes(tx))


def _risk_feat(spark, sf_dir) -> DataFrame:
    """Features with the risk category carried along on the same row."""
    tx = _risk(spark, sf_dir)
    return fe.feature_table(tx, fe.fit_type_codes(tx), extra=("risk_category",))


def _round_cols(df: DataFrame, names) -> DataFrame:
    return df.withColumns({c: r6(c) for c in names})


# ---------------------------------------------------------------- sources (S)
@register("shape", S.with_(S.TX, body="SELECT count(*) AS rows, CAST(11 AS BIGINT) AS columns FROM tx"))
def q_shape(spark, sf_dir):
    return src.shape(src.load_tx(spark, sf_dir).drop(KEY))


@register("preview", S.with_(S.TX, body="SELECT * FROM tx ORDER BY row_key LIMIT 5"))
def q_preview(spark, sf_dir):
    return src.preview(src.load_tx(spark, sf_dir), 5)


@register("type_codes", S.with_(S.TX, S.features_cte(), body="SELECT type, code FROM feat_codes"))
def q_type_codes(spark, sf_dir):
    tx = src.load_tx(spark, sf_dir)
    return fe.type_code_table(tx, fe.fit_type_codes(tx))


# ---------------------------------------------------------------- features (P)
@register("engineered_features", S.with_(S.TX, S.features_cte(), body=(
    f"SELECT row_key, {S.cols(MANAGER_FEATURE_COLS)}, isFraud FROM feat")))
def q_engineered(spark, sf_dir):
    tx = src.load_tx(spark, sf_dir)
    out = fe.engineer_features(tx, fe.fit_type_codes(tx))
    return out.select(KEY, *MANAGER_FEATURE_COLS, LABEL)


@register("feature_list", S.with_(S.TX_DIRTY, S.features_cte("tx_dirty"), body=(
    f"SELECT row_key, {S.cols()}, isFraud FROM feat")))
def q_feature_list(spark, sf_dir):
    return _feat(spark, sf_dir, dirty=True)


_MEDIAN_SQL = "(SELECT quantile_cont(amount, 0.5) FROM tx WHERE isFraud = 1)"
_RISK_SQL = f"""CAST(CASE WHEN coalesce(isFraud = 0, false) THEN 0
  WHEN coalesce(amount <= {_MEDIAN_SQL}, false) THEN 1 ELSE 2 END AS INTEGER)"""


def _risk(spark, sf_dir) -> DataFrame:
    tx = src.load_tx(spark, sf_dir)
    median = exact_percentile_value(tx.where(F.col(LABEL) == 1), "amount", 0.5)
    return tx.withColumn("risk_category", fe.risk_category_expr(median))


@register("risk_category", S.with_(S.TX, body=f"SELECT row_key, {_RISK_SQL} AS risk_category FROM tx"))
def q_risk_category(spark, sf_dir):
    return _risk(spark, sf_dir).select(KEY, "risk_category")


# ---------------------------------------------------------------- quality (Q)
@register("missing", S.with_(S.TX_DIRTY, body=" UNION ALL ".join(
    f"SELECT '{c}' AS column, {i} AS position, count(*) - count({c}) AS n_missing FROM tx_dirty"
    for i, c in enumerate(SOURCE_COLS))))
def q_missing(spark, sf_dir):
    return qu.missing_counts(src.load_tx_dirty(spark, sf_dir), SOURCE_COLS)


@register("missing_nonzero", S.with_(S.TX_DIRTY, body="SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, {i} AS position, count(*) - count({c}) AS n_missing FROM tx_dirty"
    for i, c in enumerate(SOURCE_COLS)) + ") WHERE n_missing > 0"))
def q_missing_nonzero(spark, sf_dir):
    return qu.missing_nonzero(src.load_tx_dirty(spark, sf_dir), SOURCE_COLS)


@register("dup_count", S.with_(S.TX_DIRTY, body=(
    f"SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicates FROM "
    f"(SELECT count(*) AS c FROM tx_dirty GROUP BY {S.cols(SOURCE_COLS)})")))
def q_dup_count(spark, sf_dir):
    return qu.duplicate_count(src.load_tx_dirty(spark, sf_dir), SOURCE_COLS)


@register("dedupe_full", S.with_(S.TX_DIRTY, body=(
    f"SELECT min(row_key) AS row_key, {S.cols(SOURCE_COLS)} FROM tx_dirty GROUP BY {S.cols(SOURCE_COLS)}")))
def q_dedupe_full(spark, sf_dir):
    return qu.drop_duplicates(src.load_tx_dirty(spark, sf_dir), SOURCE_COLS)


_FEAT_LABEL = MANAGER_FEATURE_COLS + [LABEL]


@register("dedupe_features", S.with_(S.TX_DIRTY, S.features_cte("tx_dirty"), body=(
    f"SELECT min(row_key) AS row_key, {S.cols(_FEAT_LABEL)} FROM feat GROUP BY {S.cols(_FEAT_LABEL)}")))
def q_dedupe_features(spark, sf_dir):
    return qu.drop_duplicates(_feat(spark, sf_dir, dirty=True), _FEAT_LABEL)


@register("drop_null", S.with_(S.TX_DIRTY, body=(
    "SELECT * FROM tx_dirty WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in SOURCE_COLS))))
def q_drop_null(spark, sf_dir):
    return qu.drop_null(src.load_tx_dirty(spark, sf_dir), SOURCE_COLS)


@register("preprocess_summary", S.with_(S.TX_DIRTY, S.features_cte("tx_dirty"), body=f"""
SELECT CAST(sum(c) AS BIGINT) AS rows_in, CAST(sum(c - 1) AS BIGINT) AS duplicates_removed,
  count(*) FILTER (WHERE anynull) AS null_rows_removed,
  count(*) FILTER (WHERE NOT anynull) AS rows_out
FROM (SELECT count(*) AS c, bool_or({' OR '.join(f'{c} IS NULL' for c in _FEAT_LABEL)}) AS anynull
      FROM feat GROUP BY {S.cols(_FEAT_LABEL)})"""))
def q_preprocess_summary(spark, sf_dir):
    return qu.preprocess_summary(_feat(spark, sf_dir, dirty=True), _FEAT_LABEL)


# ---------------------------------------------------------------- statistics (A)
_LONG = S.long_cte("feat", FEATURE_COLS)


@register("describe", S.with_(S.TX, S.features_cte(), _LONG, body="""
SELECT feature, count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
  min(x) AS min, round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50,
  round(quantile_cont(x, 0.75), 6) AS p75, max(x) AS max
FROM lng GROUP BY feature"""))
def q_describe(spark, sf_dir):
    d = st.describe(_feat(spark, sf_dir), FEATURE_COLS)
    return _round_cols(d, ["mean", "std", "p25", "p50", "p75"])


@register("corr_long", S.with_(S.TX, S.features_cte(), _LONG, body="""
SELECT a.feature AS a, b.feature AS b,
  round(CASE WHEN min(a.x) = max(a.x) OR min(b.x) = max(b.x) THEN NULL
        ELSE covar_samp(a.x, b.x) / (stddev_samp(a.x) * stddev_samp(b.x)) END, 6) AS corr
FROM lng a JOIN lng b ON a.row_key = b.row_key
WHERE a.x IS NOT NULL AND b.x IS NOT NULL
GROUP BY a.feature, b.feature"""))
def q_corr_long(spark, sf_dir):
    return _round_cols(st.corr_long(_feat(spark, sf_dir), FEATURE_COLS), ["corr"])


@register("class_counts", S.with_(S.TX, body=(
    "SELECT isFraud, count(*) AS count FROM tx WHERE isFraud IS NOT NULL GROUP BY isFraud")))
def q_class_counts(spark, sf_dir):
    return st.class_counts(src.load_tx(spark, sf_dir))


@register("class_shares", S.with_(S.TX, body=(
    "SELECT isFraud, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct "
    "FROM tx WHERE isFraud IS NOT NULL GROUP BY isFraud")))
def q_class_shares(spark, sf_dir):
    return _round_cols(st.class_shares(src.load_tx(spark, sf_dir)), ["pct"])


@register("imbalance", S.with_(S.TX, body="""
SELECT n0, n1, CAST(floor(n0 / n1) AS BIGINT) AS ratio FROM (
  SELECT count(*) FILTER (WHERE isFraud = 0) AS n0, count(*) FILTER (WHERE isFraud = 1) AS n1 FROM tx)"""))
def q_imbalance(spark, sf_dir):
    return st.imbalance(src.load_tx(spark, sf_dir))


@register("fraud_by_type", S.with_(S.TX, body="""
SELECT type, CAST(sum(isFraud) AS BIGINT) AS fraud, count(isFraud) AS total,
  round(round_even(avg(isFraud) * 100, 3), 6) AS pct
FROM tx WHERE type IS NOT NULL GROUP BY type"""))
def q_fraud_by_type(spark, sf_dir):
    return _round_cols(st.fraud_by_type(src.load_tx(spark, sf_dir)), ["pct"])


@register("fraud_rate", S.with_(S.TX, body=(
    "SELECT type, round(avg(isFraud) * 100, 6) AS fraud_rate FROM tx WHERE type IS NOT NULL GROUP BY type")))
def q_fraud_rate(spark, sf_dir):
    return _round_cols(st.fraud_rate(src.load_tx(spark, sf_dir)), ["fraud_rate"])


@register("p99", S.with_(S.TX, body="SELECT round(quantile_cont(amount, 0.99), 6) AS p99 FROM tx"))
def q_p99(spark, sf_dir):
    return _round_cols(st.percentile_of(src.load_tx(spark, sf_dir), "amount", 0.99, "p99"), ["p99"])


@register("fraud_median", S.with_(S.TX, body=f"SELECT round({_MEDIAN_SQL}, 6) AS fraud_median"))
def q_fraud_median(spark, sf_dir):
    tx = src.load_tx(spark, sf_dir).where(F.col(LABEL) == 1)
    return _round_cols(st.percentile_of(tx, "amount", 0.5, "fraud_median"), ["fraud_median"])


@register("risk_counts", S.with_(S.TX, body=f"""
SELECT r.risk_category, CAST(coalesce(c.count, 0) AS BIGINT) AS count,
  round(coalesce(c.count, 0) * 100.0 / (SELECT count(*) FROM tx), 6) AS pct
FROM (SELECT CAST(range AS INTEGER) AS risk_category FROM range(3)) r
LEFT JOIN (SELECT {_RISK_SQL} AS risk_category, count(*) AS count FROM tx GROUP BY 1) c
  ON r.risk_category = c.risk_category"""))
def q_risk_counts(spark, sf_dir):
    return _round_cols(st.risk_counts(_risk(spark, sf_dir)), ["pct"])


_HIST_COLS = st.histogram_columns(FEATURE_COLS)


@register("histogram", S.with_(S.TX, S.features_cte(), S.long_cte("feat", _HIST_COLS), f"""
capped AS (SELECT l.feature, least(l.x, q.cap) AS x FROM lng l
  JOIN (SELECT feature, quantile_cont(x, 0.99) AS cap FROM lng GROUP BY feature) q ON l.feature = q.feature
  WHERE l.x IS NOT NULL),
p AS (SELECT feature, min(x) - CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS lo,
        max(x) + CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS hi FROM capped GROUP BY feature),
c AS (SELECT l.feature, CAST(least(floor((l.x - p.lo) * 40 / (p.hi - p.lo)), 39) AS INTEGER) AS bin, count(*) AS n
      FROM capped l JOIN p ON l.feature = p.feature GROUP BY 1, 2),
g AS (SELECT feature, lo, hi, CAST(b.range AS INTEGER) AS bin FROM p, range(40) b)""", body="""
SELECT g.feature, g.bin, g.lo + g.bin * ((g.hi - g.lo) / 40) AS bin_lo,
  g.lo + (g.bin + 1) * ((g.hi - g.lo) / 40) AS bin_hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM g LEFT JOIN c ON g.feature = c.feature AND g.bin = c.bin"""))
def q_histogram(spark, sf_dir):
    return st.histogram(_feat(spark, sf_dir), _HIST_COLS)


@register("scaled", S.with_(S.TX, S.features_cte(), body=(
    "SELECT row_key, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1), 6) AS {c}"
        for c in MANAGER_FEATURE_COLS) + ", isFraud FROM feat")))
def q_scaled(spark, sf_dir):
    f = _feat(spark, sf_dir)
    stats = sc.fit_scaler(f, MANAGER_FEATURE_COLS)
    return _round_cols(sc.apply_scaler(f, stats), MANAGER_FEATURE_COLS).select(KEY, *MANAGER_FEATURE_COLS, LABEL)


@register("classes", S.with_(S.TX, body="SELECT DISTINCT isFraud FROM tx WHERE isFraud IS NOT NULL"))
def q_classes(spark, sf_dir):
    return st.classes(src.load_tx(spark, sf_dir))


@register("class_weights", S.with_(S.TX, body="""
SELECT isFraud, count(*) AS count,
  round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM tx WHERE isFraud IS NOT NULL GROUP BY isFraud"""))
def q_class_weights(spark, sf_dir):
    return _round_cols(st.class_weights(src.load_tx(spark, sf_dir)), ["weight"])


@register("pos_weight", S.with_(S.TX, body="""
SELECT n0, n1, round(n0 / n1, 6) AS pos_weight FROM (
  SELECT count(*) FILTER (WHERE isFraud = 0) AS n0, count(*) FILTER (WHERE isFraud = 1) AS n1 FROM tx)"""))
def q_pos_weight(spark, sf_dir):
    return _round_cols(st.pos_weight(src.load_tx(spark, sf_dir)), ["pos_weight"])


# ---------------------------------------------------------------- sampling (R)


def _split(spark, sf_dir) -> DataFrame:
    return sa.stratified_split(_feat(spark, sf_dir))


def _sql(*ctes, body):
    return S.with_(*ctes, body=body)


@register("split", _sql(S.TX, S.features_cte(), S.split_cte("feat"),
                        body="SELECT row_key, isFraud, split FROM spl"))
def q_split(spark, sf_dir):
    return _split(spark, sf_dir).select(KEY, LABEL, "split")


@register("split_summary", _sql(S.TX, S.features_cte(), S.split_cte("feat"), body="""
SELECT split, count(*) AS rows, CAST(sum(isFraud) AS BIGINT) AS fraud, round(avg(isFraud) * 100, 6) AS fraud_pct
FROM spl GROUP BY split"""))
def q_split_summary(spark, sf_dir):
    return _round_cols(st.split_summary(_split(spark, sf_dir)), ["fraud_pct"])


@register("split_plain", _sql(S.TX, body="""
SELECT row_key, CASE WHEN row_number() OVER (ORDER BY md5(concat(row_key, ':42')), row_key)
  <= ceil(0.2 * (SELECT count(*) FROM tx)) THEN 'test' ELSE 'train' END AS split FROM tx"""))
def q_split_plain(spark, sf_dir):
    return sa.plain_split(src.load_tx(spark, sf_dir)).select(KEY, "split")


@register("undersample", _sql(S.TX, S.features_cte(), S.split_cte("feat"),
                              "trn AS (SELECT * FROM spl WHERE split = 'train')",
                              S.take_cte("trn", "und", """CASE WHEN q.lbl = (SELECT lbl FROM und_cc ORDER BY n_c, lbl LIMIT 1)
    THEN q.n_c ELSE least(q.n_c, CAST(trunc((SELECT min(n_c) FROM und_cc) / 0.1) AS BIGINT)) END"""),
                              body="SELECT row_key, isFraud FROM und"))
def q_undersample(spark, sf_dir):
    train = _split(spark, sf_dir).where(F.col("split") == "train")
    return sa.undersample(train).select(KEY, LABEL)


@register("balanced_sample", _sql(S.TX, S.features_cte(), S.take_cte("feat", "bal", "2500"),
                                  body="SELECT row_key, isFraud FROM bal"))
def q_balanced_sample(spark, sf_dir):
    return sa.balanced_sample(_feat(spark, sf_dir), 2500).select(KEY, LABEL)


_SCATTER_COLS = [c for c in MANAGER_FEATURE_COLS
                 if c not in ("orig_zeroed", "suspicious_type", "type_encoded")][:5]


@register("scatter_sample", _sql(S.TX, S.features_cte(), S.take_cte("feat", "sct", "1500"),
                                 "cap AS (SELECT " + ", ".join(
                                     f"quantile_cont({c}, 0.99) AS {c}" for c in _SCATTER_COLS) + " FROM sct)",
                                 body="SELECT s.row_key, " + ", ".join(
                                     f"CASE WHEN s.{c} IS NULL THEN NULL ELSE least(s.{c}, cap.{c}) END AS {c}"
                                     for c in _SCATTER_COLS)
                                 + ", CASE s.isFraud WHEN 0 THEN 'Normal' WHEN 1 THEN 'Fraud' END AS class_name"
                                 + " FROM sct s, cap"))
def q_scatter_sample(spark, sf_dir):
    return pl.scatter_sample(_feat(spark, sf_dir), _SCATTER_COLS, 1500)


@register("folds", _sql(S.TX, S.features_cte(), S.split_cte("feat"),
                        "trn AS (SELECT * FROM spl WHERE split = 'train')",
                        """fc AS (SELECT isFraud AS lbl, count(*) AS n_c,
    coalesce(sum(count(*)) OVER (ORDER BY isFraud ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st
  FROM trn GROUP BY isFraud),
fb AS (SELECT lbl, st, n_c,
    (CASE WHEN st + n_c <= 0 THEN 0 ELSE (st + n_c - 1) // 3 + 1 END) - (CASE WHEN st <= 0 THEN 0 ELSE (st - 1) // 3 + 1 END) AS a0,
    (CASE WHEN st + n_c <= 1 THEN 0 ELSE (st + n_c - 2) // 3 + 1 END) - (CASE WHEN st <= 1 THEN 0 ELSE (st - 2) // 3 + 1 END) AS a1
  FROM fc)""", body="""
SELECT row_key, isFraud, CAST(CASE WHEN rn < a0 THEN 0 WHEN rn < a0 + a1 THEN 1 ELSE 2 END AS INTEGER) AS fold
FROM (SELECT t.*, row_number() OVER (PARTITION BY isFraud ORDER BY md5(concat(row_key, ':42')), row_key) - 1 AS rn
      FROM trn t) t JOIN fb ON t.isFraud = fb.lbl"""))
def q_folds(spark, sf_dir):
    train = _split(spark, sf_dir).where(F.col("split") == "train")
    return sa.stratified_folds(train).select(KEY, LABEL, "fold")


@register("shuffle_order", _sql(S.TX, body="""
SELECT row_key, row_number() OVER (ORDER BY md5(concat(row_key, ':42')), row_key) - 1 AS position FROM tx"""))
def q_shuffle_order(spark, sf_dir):
    """K6: the seeded shuffle order as a 0-based position of every row."""
    return sa.digest_rank(src.load_tx(spark, sf_dir).select(KEY), out="position")


# ---------------------------------------------------------------- metrics
def _pred(spark, sf_dir) -> DataFrame:
    """rule-based predictions (no model) over the feature table."""
    f = _feat(spark, sf_dir)
    hit = F.col("suspicious_type") * F.col("orig_zeroed")
    return f.select(KEY, F.col(LABEL).alias("label"), hit.alias("prediction"),
                    (F.col("amount") * hit).alias("score"))


def _pred3(spark, sf_dir) -> DataFrame:
    f = _risk_feat(spark, sf_dir)
    hit = F.col("suspicious_type") * F.col("orig_zeroed")
    pred = F.when(hit == 0, 0).when(F.col("amount") <= 100, 1).otherwise(2).cast("int")
    return f.select(KEY, F.col("risk_category").alias("label"), pred.alias("prediction"))


_M = (S.TX, S.features_cte(), S.PRED_CTE, S.METRIC_CTES)
_M3 = (S.TX, S.features_cte(), S.pred3_cte(_RISK_SQL), S.METRIC_CTES)


@register("confusion", _sql(*_M, body="SELECT label, prediction, count FROM conf"))
def q_confusion(spark, sf_dir):
    return me.confusion(_pred(spark, sf_dir))


@register("confusion_3class", _sql(*_M3, body="SELECT label, prediction, count FROM conf"))
def q_confusion3(spark, sf_dir):
    return me.confusion(_pred3(spark, sf_dir))


_PC_COLS = ["precision", "recall", "f1"]


@register("per_class", _sql(*_M, body=(
    "SELECT label, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(f1, 6) AS f1, support FROM pc")))
def q_per_class(spark, sf_dir):
    return _round_cols(me.per_class(me.confusion(_pred(spark, sf_dir))), _PC_COLS)


@register("per_class_3class", _sql(*_M3, body=(
    "SELECT label, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(f1, 6) AS f1, support FROM pc")))
def q_per_class3(spark, sf_dir):
    return _round_cols(me.per_class(me.confusion(_pred3(spark, sf_dir))), _PC_COLS)


@register("accuracy", _sql(*_M, body="SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pred"))
def q_accuracy(spark, sf_dir):
    return _round_cols(me.accuracy(_pred(spark, sf_dir)), ["accuracy"])


def _modes_sql(metric, ctes, fn=S.avg_sql):
    return _sql(*ctes, body=" UNION ALL ".join(
        f"SELECT '{a}' AS average, round({fn(metric, a)}, 6) AS {metric}" for a in me.AVERAGES))


def _f1_sql(mode, ctes):
    return _sql(*ctes, body=" UNION ALL ".join(
        f"SELECT '{a}' AS average, round({S.f1_sql(a, mode)}, 6) AS f1" for a in me.AVERAGES))


@register("precision_modes", _modes_sql("precision", _M))
def q_precision_modes(spark, sf_dir):
    return _round_cols(me.metric_modes(me.per_class(me.confusion(_pred(spark, sf_dir))), "precision"), ["precision"])


@register("recall_modes", _modes_sql("recall", _M))
def q_recall_modes(spark, sf_dir):
    return _round_cols(me.metric_modes(me.per_class(me.confusion(_pred(spark, sf_dir))), "recall"), ["recall"])


@register("precision_modes_3class", _modes_sql("precision", _M3))
def q_precision_modes3(spark, sf_dir):
    return _round_cols(me.metric_modes(me.per_class(me.confusion(_pred3(spark, sf_dir))), "precision"), ["precision"])


@register("recall_modes_3class", _modes_sql("recall", _M3))
def q_recall_modes3(spark, sf_dir):
    return _round_cols(me.metric_modes(me.per_class(me.confusion(_pred3(spark, sf_dir))), "recall"), ["recall"])


@register("f1_per_class", _f1_sql("per_class", _M3))
def q_f1_per_class(spark, sf_dir):
    return _round_cols(me.f1_modes(me.per_class(me.confusion(_pred3(spark, sf_dir))), "per_class"), ["f1"])


@register("f1_of_averages", _f1_sql("of_averages", _M3))
def q_f1_of_averages(spark, sf_dir):
    return _round_cols(me.f1_modes(me.per_class(me.confusion(_pred3(spark, sf_dir))), "of_averages"), ["f1"])


@register("auc", _sql(*_M, body=f"SELECT round({S.AUC_SQL}, 6) AS roc_auc"))
def q_auc(spark, sf_dir):
    return _round_cols(me.roc_auc(_pred(spark, sf_dir)), ["roc_auc"])


@register("roc_points", _sql(*_M, body="""
SELECT CAST('Infinity' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL
SELECT s AS threshold,
  round(sum(neg) OVER (ORDER BY s DESC) / sum(neg) OVER (), 6) AS fpr,
  round(sum(pos) OVER (ORDER BY s DESC) / sum(pos) OVER (), 6) AS tpr
FROM (SELECT score AS s, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
        sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg FROM pred WHERE score IS NOT NULL GROUP BY score)"""))
def q_roc_points(spark, sf_dir):
    return _round_cols(me.roc_points(_pred(spark, sf_dir)), ["fpr", "tpr"])


_ROC_DROP = """, pt AS (SELECT s, pos, neg, lead(pos) OVER w AS pos1, lead(neg) OVER w AS neg1, lag(s) OVER w AS above,
  sum(neg) OVER w / sum(neg) OVER () AS fpr, sum(pos) OVER w / sum(pos) OVER () AS tpr
  FROM (SELECT score AS s, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
    sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg FROM pred WHERE score IS NOT NULL GROUP BY score)
  WINDOW w AS (ORDER BY s DESC))
SELECT CAST('Infinity' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL SELECT s, round(fpr, 6), round(tpr, 6) FROM pt WHERE above IS NULL OR pos1 IS NULL OR {corner}"""


@register("roc_corners", _sql(*_M, body="").rstrip() + _ROC_DROP.format(corner="pos * neg1 <> neg * pos1"))
def q_roc_corners(spark, sf_dir):
    """A21 without collinear points."""
    return _round_cols(me.roc_points(_pred(spark, sf_dir), drop="collinear"), ["fpr", "tpr"])


@register("roc_points_dropped", _sql(*_M, body="").rstrip() + _ROC_DROP.format(corner="pos <> pos1 OR neg <> neg1"))
def q_roc_points_dropped(spark, sf_dir):
    """A21 without points between equal steps (the library's rule)."""
    return _round_cols(me.roc_points(_pred(spark, sf_dir), drop="equal_steps"), ["fpr", "tpr"])


@register("report_row", _sql(*_M, body=f"""
SELECT round((SELECT sum(tp) / sum(support) FROM pc), 6) AS accuracy,
  round({S.avg_sql('precision', 'binary')}, 6) AS precision, round({S.avg_sql('recall', 'binary')}, 6) AS recall,
  round({S.avg_sql('f1', 'binary')}, 6) AS f1, round({S.AUC_SQL}, 6) AS roc_auc"""))
def q_report_row(spark, sf_dir):
    return _round_cols(me.report_row(_pred(spark, sf_dir)), ["accuracy", "precision", "recall", "f1", "roc_auc"])


@register("class_report", _sql(*_M3, body="""
SELECT CAST(label AS VARCHAR) AS row, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, support FROM pc
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), sum(support) FROM pc
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support) FROM pc
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support) FROM pc"""))
def q_class_report(spark, sf_dir):
    return _round_cols(me.class_report(_pred3(spark, sf_dir)),
                       ["precision", "recall", "f1"])


@register("naive_metrics", _sql(S.TX, S.features_cte(), S.split_cte("feat"),
                                "pred AS (SELECT row_key, isFraud AS label, 0 AS prediction FROM spl WHERE split = 'test')",
                                S.METRIC_CTES, body=f"""
SELECT round((SELECT sum(tp) / sum(support) FROM pc), 6) AS accuracy,
  round({S.avg_sql('precision', 'binary')}, 6) AS precision, round({S.avg_sql('recall', 'binary')}, 6) AS recall,
  round({S.avg_sql('f1', 'binary')}, 6) AS f1"""))
def q_naive_metrics(spark, sf_dir):
    """The all-zero predictor on the test split (accuracy = 1 - fraud share)."""
    test = _split(spark, sf_dir).where(F.col("split") == "test")
    pred = test.select(KEY, F.col(LABEL).alias("label"), F.lit(0).alias("prediction"))
    row = me.report_row(pred, score=None, pos_label=1).drop("roc_auc")
    return _round_cols(row, ["accuracy", "precision", "recall", "f1"])


# ---------------------------------------------------------------- kNN (J1, M8-M10) and SMOTE


def _emb_split(spark, sf_dir):
    e = src.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vec"), "label")
    s = sa.stratified_split(e, label="label", key="vec_id")
    q = s.where(F.col("split") == "test").select(F.col("vec_id").alias("qid"), "vec")
    t = s.where(F.col("split") == "train").select(F.col("vec_id").alias("tid"), "vec", "label")
    return q, t


_EMB_SPLIT = (S.EMB, S.split_cte("emb", label="label", key="vec_id"))


@register("knn_join", _sql(*_EMB_SPLIT, S.knn_ctes("euclidean"),
                           body="SELECT qid, rank, tid, round(distance, 6) AS distance FROM nn"))
def q_knn_join(spark, sf_dir):
    q, t = _emb_split(spark, sf_dir)
    return _round_cols(kn.knn_join(q, t, 5, "euclidean").select("qid", "rank", "tid", "distance"), ["distance"])


@register("knn_approx")
def q_knn_approx(spark, sf_dir):
    """J1, approximate branch at an audited recall of 0.95."""
    q, t = _emb_split(spark, sf_dir)
    return _round_cols(kn.knn_join_approx(q, t, 5, "euclidean").rows, ["distance"])


def _knn_pred_query(metric, weights, mode):
    def fn(spark, sf_dir):
        q, t = _emb_split(spark, sf_dir)
        nn = kn.knn_join(q, t, 5, metric, label="label")
        return kn.knn_predict(nn, weights, mode)
    return fn


for _m in ("euclidean", "manhattan", "cosine"):
    register(f"knn_{_m}", _sql(*_EMB_SPLIT, S.knn_ctes(_m), S.NNW_EPS, S.vote_sql("w"),
                               body="SELECT qid, prediction FROM pr"))(_knn_pred_query(_m, "distance", "eps"))
register("knn_lib_uniform", _sql(*_EMB_SPLIT, S.knn_ctes("euclidean"), S.NNW_UNIFORM, S.vote_sql("w"),
                                 body="SELECT qid, prediction FROM pr"))(
    _knn_pred_query("euclidean", "uniform", "exact_match"))
register("knn_lib_distance", _sql(*_EMB_SPLIT, S.knn_ctes("euclidean"), S.NNW_EXACT, S.vote_sql("w"),
                                  body="SELECT qid, prediction FROM pr"))(
    _knn_pred_query("euclidean", "distance", "exact_match"))


@register("knn_proba", _sql(*_EMB_SPLIT, S.knn_ctes("euclidean"), S.NNW_EXACT, """
cls AS (SELECT DISTINCT label FROM kt),
vt AS (SELECT qid, label, sum(w) AS vote FROM nnw GROUP BY qid, label),
tot AS (SELECT qid, sum(vote) AS t FROM vt GROUP BY qid)""", body="""
SELECT tot.qid, cls.label, round(coalesce(vt.vote, 0.0) / tot.t, 6) AS proba
FROM tot CROSS JOIN cls LEFT JOIN vt ON vt.qid = tot.qid AND vt.label = cls.label"""))
def q_knn_proba(spark, sf_dir):
    q, t = _emb_split(spark, sf_dir)
    classes = sorted(r[0] for r in t.select("label").distinct().collect())
    nn = kn.knn_join(q, t, 5, "euclidean", label="label")
    return _round_cols(kn.knn_proba(nn, classes, "distance", "exact_match"), ["proba"])


_SM_FEATS = FEATURE_COLS
_SMOTE_CTES = """
cnt AS (SELECT count(*) FILTER (WHERE isFraud = 1) AS n1, count(*) FILTER (WHERE isFraud = 0) AS n0 FROM trn),
mino AS (SELECT * FROM trn WHERE isFraud = 1),
idx AS (SELECT *, row_number() OVER (ORDER BY md5(concat(row_key, ':42')), row_key) - 1 AS idx FROM mino),
nn AS (SELECT qid, tid, rank FROM (SELECT a.row_key AS qid, b.row_key AS tid, row_number() OVER (
    PARTITION BY a.row_key ORDER BY list_distance([{distance_cols_a}]::DOUBLE[],
      [{distance_cols_b}]::DOUBLE[]), b.row_key) AS rank
  FROM mino a JOIN mino b ON a.row_key <> b.row_key) WHERE rank <= 5),
gen AS (SELECT range AS i FROM range((SELECT CAST(trunc(0.1 * n0) AS BIGINT) - n1 FROM cnt))),
g2 AS (SELECT i, CAST(floor(""" + S.u_sql("i", "base") + """ * (SELECT n1 FROM cnt)) AS BIGINT) AS idx,
    CAST(floor(""" + S.u_sql("i", "nb") + """ * 5) AS BIGINT) + 1 AS rank, """ + S.u_sql("i", "step") + """ AS gap FROM gen),
"""
_SMOTE_FROM = """, 1 AS isFraud
  FROM g2 g JOIN idx b ON g.idx = b.idx JOIN nn ON nn.qid = b.row_key AND nn.rank = g.rank
  JOIN mino n ON n.row_key = nn.tid)"""
_SMOTE_SQL = _sql(S.TX, S.features_cte(), S.split_cte("feat"), """
trn AS (SELECT * FROM spl WHERE split = 'train'),""" + _SMOTE_CTES.format(
    distance_cols_a=S.cols(_SM_FEATS, "a."), distance_cols_b=S.cols(_SM_FEATS, "b."))
    + "syn AS (SELECT -(g.i + 1) AS row_key, " + ", ".join(
    (f"CAST(trunc(b.{c} + g.gap * (n.{c} - b.{c})) AS {'BIGINT' if c == 'step' else 'INTEGER'}) AS {c}"
     if c in ("step", "type_encoded", "orig_zeroed", "suspicious_type")
     else f"b.{c} + g.gap * (n.{c} - b.{c}) AS {c}") for c in _SM_FEATS) + _SMOTE_FROM, body=(
    "SELECT row_key, " + ", ".join(f"round({c}, 6) AS {c}" for c in _SM_FEATS) + ", isFraud FROM trn "
    "UNION ALL SELECT row_key, " + ", ".join(f"round({c}, 6) AS {c}" for c in _SM_FEATS) + ", isFraud FROM syn"))


@register("smote", _SMOTE_SQL)
def q_smote(spark, sf_dir):
    train = _split(spark, sf_dir).where(F.col("split") == "train")
    out = smote(train, _SM_FEATS)
    return out.withColumns({c: r6(c) for c in _SM_FEATS})


# ---------------------------------------------------------------- Gaussian NB, closed form (M3, oracle)


def _scaled_split(spark, sf_dir):
    s = _split(spark, sf_dir)
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    stats = sc.fit_scaler(train, FEATURE_COLS)
    return sc.apply_scaler(train, stats), sc.apply_scaler(test, stats)


def _gnb_sql() -> str:
    fs = FEATURE_COLS
    stat = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in fs)
    scale = lambda src: ", ".join(
        f"({src}.{c} - st.m_{c}) / coalesce(nullif(st.s_{c}, 0), 1) AS {c}" for c in fs)
    const = " + ".join(f"ln(2 * pi() * v_{c})" for c in fs)
    quad = " - ".join(f"(t.{c} - m_{c}) * (t.{c} - m_{c}) / (2 * v_{c})" for c in fs)
    return _sql(S.TX, S.features_cte(), S.split_cte("feat"), f"""
st AS (SELECT {stat} FROM spl WHERE split = 'train'),
strn AS (SELECT s.row_key, s.isFraud, {scale('s')} FROM spl s, st WHERE s.split = 'train'),
stst AS (SELECT s.row_key, s.isFraud, {scale('s')} FROM spl s, st WHERE s.split = 'test'),
gv AS (SELECT {GNB_EPS_SQL} AS eps FROM strn),
cp AS (SELECT isFraud AS c, count(*) / (SELECT count(*) FROM strn) AS prior,
    {', '.join(f'avg({c}) AS m_{c}, var_pop({c}) + (SELECT eps FROM gv) AS v_{c}' for c in fs)}
  FROM strn GROUP BY isFraud),
jl AS (SELECT t.row_key, t.isFraud, cp.c, (ln(cp.prior) - 0.5 * ({const})) - {quad} AS jll FROM stst t, cp)""",
                body="""SELECT j.row_key, j.isFraud AS label, CAST(CASE WHEN j1.jll > j0.jll THEN 1 ELSE 0 END AS INTEGER)
  AS prediction, round(exp(j1.jll - (greatest(j0.jll, j1.jll) + ln(exp(j0.jll - greatest(j0.jll, j1.jll))
  + exp(j1.jll - greatest(j0.jll, j1.jll))))), 6) AS score
FROM (SELECT DISTINCT row_key, isFraud FROM jl) j JOIN jl j0 ON j0.row_key = j.row_key AND j0.c = 0
JOIN jl j1 ON j1.row_key = j.row_key AND j1.c = 1""")


GNB_EPS_SQL = "1e-9 * greatest(" + ", ".join(f"var_pop({c})" for c in FEATURE_COLS) + ")"


@register("gnb_sql", _gnb_sql())
def q_gnb_sql(spark, sf_dir):
    train, test = _scaled_split(spark, sf_dir)
    params = mo.gnb_fit(train, FEATURE_COLS, LABEL)
    out = mo.gnb_predict(test, params, FEATURE_COLS)
    return out.select(KEY, F.col(LABEL).alias("label"), F.col("prediction").cast("int"), r6("score").alias("score"))


# ---------------------------------------------------------------- models of the study


def _study(spark, sf_dir) -> pl.Study:
    return pl.Study(_feat(spark, sf_dir))


def _study_query(name: str, model: str):
    @register(name)
    def fn(spark, sf_dir):
        return _study(spark, sf_dir).row(model)
    return fn


for _name, _model in (("lr", "logistic"), ("dt", "tree"), ("rf", "forest"), ("gbt", "boosting"),
                      ("voting", "voting"), ("stacking", "stacking")):
    _study_query(_name, _model)


@register("gnb_ml", _gnb_sql())
def q_gnb_ml(spark, sf_dir):
    """M3 by the library's Gaussian naive Bayes: same rows as the closed form."""
    train, test = pl.prepare(_feat(spark, sf_dir), scaled=True)
    out = mo.predict_binary(mo.gaussian_nb().fit(train), test)
    return out.select(KEY, "label", "prediction", r6("score").alias("score"))


def _tree(spark, sf_dir):
    train, _ = pl.prepare(_feat(spark, sf_dir))
    return mo.decision_tree(pl.TREE_DEPTH, weight_col="weight").fit(train)


@register("importances")
def q_importances(spark, sf_dir):
    return mo.importances(_tree(spark, sf_dir), FEATURE_COLS, 12)


@register("tree_nodes")
def q_tree_nodes(spark, sf_dir):
    return mo.tree_nodes(_tree(spark, sf_dir), FEATURE_COLS, 4)


@register("leaderboard")
def q_leaderboard(spark, sf_dir):
    return _study(spark, sf_dir).board()


@register("metric_ranking")
def q_metric_ranking(spark, sf_dir):
    return pl.metric_ranking(_study(spark, sf_dir).board())


@register("balancing_comparison")
def q_balancing(spark, sf_dir):
    return pl.balancing_comparison(_study(spark, sf_dir).board(pl.Study.BALANCING))


def _risk_split(spark, sf_dir) -> DataFrame:
    return sa.stratified_split(_risk_feat(spark, sf_dir), label="risk_category")


@register("split_3class", _sql(S.TX, S.features_cte(), f"rfeat AS (SELECT *, {_RISK_SQL} AS risk_category FROM feat)",
                               S.split_cte("rfeat", label="risk_category"),
                               body="SELECT row_key, risk_category, split FROM spl"))
def q_split_3class(spark, sf_dir):
    return _risk_split(spark, sf_dir).select(KEY, "risk_category", "split")


def _multiclass(spark, sf_dir):
    split = cut_lineage(_risk_split(spark, sf_dir).withColumnRenamed("risk_category", "label"))
    train = with_weights(split.where(F.col("split") == "train"), "label")
    train = cut_lineage(mo.assemble(train, FEATURE_COLS))
    test = mo.assemble(split.where(F.col("split") == "test"), FEATURE_COLS)
    return mo.random_forest(*pl.RISK_FOREST, binary=False, weight_col="weight").fit(train), test


@register("multiclass")
def q_multiclass(spark, sf_dir):
    """Three-class forest on the risk category; classification report."""
    model, test = _multiclass(spark, sf_dir)
    pred = model.transform(test).withColumn("prediction", F.col("prediction").cast("int"))
    return me.class_report(pred, "label", "prediction", RISK_NAMES)


def _risk_scored(df: DataFrame, proba: str) -> DataFrame:
    """Category name, fraud flag and class probabilities of scored rows."""
    p = F.col(proba)
    return df.select("*", fe.code_to_name(F.col("prediction"), RISK_NAMES).alias("risk_name"),
                     F.when(F.col("prediction") > 0, "FRAUD").otherwise("NORMAL").alias("flag"),
                     p[0].alias("p_normal"), p[1].alias("p_small"), p[2].alias("p_large"))


@register("score_new")
def q_score_new(spark, sf_dir):
    """The literal transactions, encoded through the fitted mapping."""
    from pyspark.ml.functions import vector_to_array
    model, _ = _multiclass(spark, sf_dir)
    cats = fe.fit_type_codes(src.load_tx(spark, sf_dir))
    feats = mo.assemble(fe.engineer_features(src.new_transactions(spark), cats, drop=False), FEATURE_COLS)
    out = model.transform(feats).withColumn("prediction", F.col("prediction").cast("int")) \
        .withColumn("proba", vector_to_array("probability"))
    return _risk_scored(out, "proba").select("tx_id", "description", F.col("prediction").alias("risk_category"),
                                             "risk_name", "flag", "p_normal", "p_small", "p_large", "type_encoded",
                                             "literal_type_code")


# ---------------------------------------------------------------- the same composites over closed-form predictors
def _gnb3(spark, sf_dir):
    """Three-class Gaussian naive Bayes: scored test rows."""
    split = cut_lineage(_risk_split(spark, sf_dir))
    train, test = split.where(F.col("split") == "train"), split.where(F.col("split") == "test")
    stats = sc.fit_scaler(train, FEATURE_COLS)
    params = mo.gnb_fit(sc.apply_scaler(train, stats), FEATURE_COLS, "risk_category")
    return mo.gnb_predict(sc.apply_scaler(test, stats), params, FEATURE_COLS, "proba") \
        .select(KEY, F.col("risk_category").alias("label"), "prediction", "proba")


def _gnb3_ctes():
    """SQL twin of ``_gnb3``: pred(row_key, label, prediction, p0, p1, p2)."""
    fs = FEATURE_COLS
    stat = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in fs)
    scale = ", ".join(f"(s.{c} - st.m_{c}) / coalesce(nullif(st.s_{c}, 0), 1) AS {c}" for c in fs)
    const = " + ".join(f"ln(2 * pi() * v_{c})" for c in fs)
    quad = " + ".join(f"(t.{c} - m_{c}) * (t.{c} - m_{c}) / (2 * v_{c})" for c in fs)
    return (S.TX, S.features_cte(), f"rfeat AS (SELECT *, {_RISK_SQL} AS risk_category FROM feat)",
            S.split_cte("rfeat", label="risk_category"), f"""
st AS (SELECT {stat} FROM spl WHERE split = 'train'),
z AS (SELECT s.row_key, s.risk_category AS y, s.split, {scale} FROM spl s, st),
cp AS (SELECT y AS c, count(*) / (SELECT count(*) FROM z WHERE split = 'train') AS prior,
    {', '.join(f"avg({c}) AS m_{c}, var_pop({c}) + (SELECT {GNB_EPS_SQL} FROM z WHERE split = 'train') AS v_{c}" for c in fs)}
  FROM z WHERE split = 'train' GROUP BY y),
jl AS (SELECT t.row_key, t.y, cp.c, ln(cp.prior) - 0.5 * ({const}) - ({quad}) AS jll
  FROM z t, cp WHERE t.split = 'test'),
pr AS (SELECT row_key, y, c, jll, exp(jll - max(jll) OVER (PARTITION BY row_key)) AS e FROM jl),
pred AS (SELECT row_key, any_value(y) AS label, arg_min(c, (-jll, c)) AS prediction,
    max(CASE WHEN c = 0 THEN e END) / sum(e) AS p0, max(CASE WHEN c = 1 THEN e END) / sum(e) AS p1,
    max(CASE WHEN c = 2 THEN e END) / sum(e) AS p2 FROM pr GROUP BY row_key)""")


@register("gnb_3class_report", _sql(*_gnb3_ctes(), S.METRIC_CTES, body=f"""
SELECT CASE label {' '.join(f"WHEN {k} THEN '{v}'" for k, v in RISK_NAMES.items())} END AS row,
  round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM pc
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), sum(support) FROM pc
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support) FROM pc
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support) FROM pc"""))
def q_gnb3_report(spark, sf_dir):
    return _round_cols(me.class_report(_gnb3(spark, sf_dir), names=RISK_NAMES), ["precision", "recall", "f1"])


@register("gnb_3class_confusion", _sql(*_gnb3_ctes(), S.METRIC_CTES, body="SELECT label, prediction, count FROM conf"))
def q_gnb3_confusion(spark, sf_dir):
    return me.confusion(_gnb3(spark, sf_dir))


@register("gnb_3class_scores", _sql(*_gnb3_ctes(), body=f"""
SELECT row_key, prediction AS risk_category,
  CASE prediction {' '.join(f"WHEN {k} THEN '{v}'" for k, v in RISK_NAMES.items())} END AS risk_name,
  CASE WHEN prediction > 0 THEN 'FRAUD' ELSE 'NORMAL' END AS flag,
  round(p0, 6) AS p_normal, round(p1, 6) AS p_small, round(p2, 6) AS p_large FROM pred"""))
def q_gnb3_scores(spark, sf_dir):
    out = _risk_scored(_gnb3(spark, sf_dir), "proba").withColumnRenamed("prediction", "risk_category")
    return _round_cols(out.select(KEY, "risk_category", "risk_name", "flag", "p_normal", "p_small", "p_large"),
                       ["p_normal", "p_small", "p_large"])


@register("pipeline_scores", ORACLE["gnb_3class_scores"])
def q_pipeline_scores(spark, sf_dir):
    """P1 + M17: a fitted pipeline over raw transactions, saved, loaded and
    applied to the test rows."""
    tx = cut_lineage(sa.stratified_split(_risk(spark, sf_dir), label="risk_category"))
    pipeline = ft.transaction_pipeline(es.ClosedFormNB(labelCol="risk_category"), scaled=True)
    model = ft.load_fitted(ft.save_fitted(pipeline.fit(tx.where(F.col("split") == "train")), spark))
    new = tx.where(F.col("split") == "test").drop("risk_category", "split")
    out = ft.score_risk(model, new)
    return _round_cols(out.select(KEY, "risk_category", "risk_name", "flag", "p_normal", "p_small", "p_large"),
                       ["p_normal", "p_small", "p_large"])


def _closed_predictions(spark, sf_dir) -> dict[str, DataFrame]:
    """Predictors without a solver on the test rows: rule, naive Bayes, all zero."""
    train, test = _scaled_split(spark, sf_dir)
    nb = mo.gnb_predict(test, mo.gnb_fit(train, FEATURE_COLS, LABEL), FEATURE_COLS) \
        .select(KEY, "prediction", r6("score").alias("score"))
    raw = cut_lineage(_split(spark, sf_dir).where(F.col("split") == "test"))
    hit = F.col("suspicious_type") * F.col("orig_zeroed")
    rule = raw.select(KEY, F.col(LABEL).alias("label"), hit.alias("prediction"), hit.cast("double").alias("score"))
    return {"Rule": rule, "Naive Bayes": rule.select(KEY, "label").join(nb, KEY),
            "All zero": rule.select(KEY, "label", F.lit(0).alias("prediction"))}


def _closed_board(spark, sf_dir) -> DataFrame:
    rows = pl.evaluate_all({m: (p, None) for m, p in _closed_predictions(spark, sf_dir).items()})
    return _round_cols(pl.leaderboard([rows]).drop("train_seconds"), ["accuracy", "precision", "recall", "f1", "roc_auc"])


# preds(model, label, prediction, score) -> board, one row a model
_BOARD = """cm AS (SELECT model, count(*) AS n, sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS hit,
    sum(label * prediction) AS tp, sum(prediction) AS pp, sum(label) AS p FROM preds GROUP BY model),
sc AS (SELECT model, score AS s, sum(label) AS pos, sum(1 - label) AS neg FROM preds WHERE score IS NOT NULL
  GROUP BY model, score),
au AS (SELECT model, sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS roc_auc FROM (
    SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS below FROM sc) GROUP BY model),
m1 AS (SELECT cm.model, hit / n AS accuracy, coalesce(tp / nullif(pp, 0), 0.0) AS precision,
    coalesce(tp / nullif(p, 0), 0.0) AS recall, roc_auc FROM cm LEFT JOIN au ON cm.model = au.model),
board AS (SELECT model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
    round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 6) AS f1,
    round(roc_auc, 6) AS roc_auc FROM m1)
"""
_CLOSED_CTES = _gnb_sql().removeprefix("WITH ").rsplit("SELECT j.row_key", 1)
_CLOSED = ("WITH " + _CLOSED_CTES[0].rstrip() + ",\nnbp AS (SELECT j.row_key" + _CLOSED_CTES[1] + """),
preds AS (SELECT 'Rule' AS model, row_key, isFraud AS label, suspicious_type * orig_zeroed AS prediction,
    CAST(suspicious_type * orig_zeroed AS DOUBLE) AS score FROM spl WHERE split = 'test'
  UNION ALL SELECT 'Naive Bayes', row_key, label, prediction, score FROM nbp
  UNION ALL SELECT 'All zero', row_key, isFraud, 0, NULL FROM spl WHERE split = 'test'),
""" + _BOARD)


@register("leaderboard_closed", _CLOSED + "SELECT * FROM board")
def q_leaderboard_closed(spark, sf_dir):
    return _closed_board(spark, sf_dir)


@register("metric_ranking_closed", _CLOSED + """
SELECT model, metric, value, CAST(row_number() OVER (PARTITION BY metric ORDER BY value DESC, model) AS INTEGER) AS rank
FROM (UNPIVOT board ON accuracy, precision, recall, f1, roc_auc INTO NAME metric VALUE value) WHERE value IS NOT NULL""")
def q_metric_ranking_closed(spark, sf_dir):
    return pl.metric_ranking(_closed_board(spark, sf_dir))


@register("balancing_closed", _CLOSED + "SELECT model, precision, recall, f1 FROM board WHERE model IN ('Rule', 'All zero')")
def q_balancing_closed(spark, sf_dir):
    return pl.balancing_comparison(_closed_board(spark, sf_dir), ("Rule", "All zero"))


@register("report_by_type", _sql(S.TX, S.features_cte(), S.PRED_CTE, """
preds AS (SELECT tx.type AS model, p.label, p.prediction, p.score FROM pred p JOIN tx ON tx.row_key = p.row_key)""",
                                 _BOARD.rstrip(), body="SELECT model AS type, accuracy, precision, recall, f1, roc_auc FROM board"))
def q_report_by_type(spark, sf_dir):
    """A22 per transaction type, of the rule's predictions, in one aggregation."""
    tx = src.load_tx(spark, sf_dir)
    f = fe.feature_table(tx, fe.fit_type_codes(tx), extra=("type",))
    hit = F.col("suspicious_type") * F.col("orig_zeroed")
    pred = f.select("type", F.col(LABEL).alias("label"), hit.alias("prediction"), (F.col("amount") * hit).alias("score"))
    return _round_cols(me.report_rows(pred, "type").drop("support"), ["accuracy", "precision", "recall", "f1", "roc_auc"])


@register("voting_closed", _CLOSED + """
SELECT row_key, label, CAST(CASE WHEN avg(score) > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction,
  round(avg(score), 5) AS score
FROM preds WHERE score IS NOT NULL GROUP BY row_key, label""")
def q_voting_closed(spark, sf_dir):
    """M6: the soft-vote combiner over the rule and naive Bayes."""
    p = _closed_predictions(spark, sf_dir)
    both = p["Rule"].select(KEY, "label", F.col("score").alias("p_rule")).join(
        p["Naive Bayes"].select(KEY, F.col("score").alias("p_nb")), KEY)
    return en.soft_vote(both, ["rule", "nb"]).select(KEY, "label", "prediction", r6("score", 5).alias("score"))


# ---------------------------------------------------------------- preprocessing and manager-mode rebalancing
def _preprocessed(spark, sf_dir) -> DataFrame:
    return qu.preprocess(_feat(spark, sf_dir, dirty=True), MANAGER_FEATURE_COLS)


_PRE_CTES = (S.TX_DIRTY, S.features_cte("tx_dirty"), f"""
dd AS (SELECT min(row_key) AS row_key, {S.cols(_FEAT_LABEL)} FROM feat GROUP BY {S.cols(_FEAT_LABEL)}),
nn0 AS (SELECT * FROM dd WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _FEAT_LABEL)}),
pre AS (SELECT row_key, """ + ", ".join(
    f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1) AS {c}" for c in MANAGER_FEATURE_COLS)
    + ", isFraud FROM nn0)")
_R_FEATS = ", ".join(f"round({c}, 6) AS {c}" for c in MANAGER_FEATURE_COLS)


@register("preprocess", _sql(*_PRE_CTES, body=f"SELECT row_key, {_R_FEATS}, isFraud FROM pre"))
def q_preprocess(spark, sf_dir):
    return _round_cols(_preprocessed(spark, sf_dir), MANAGER_FEATURE_COLS).select(KEY, *MANAGER_FEATURE_COLS, LABEL)


def _scaled_train(spark, sf_dir) -> DataFrame:
    split = sa.stratified_split(_preprocessed(spark, sf_dir))
    return cut_lineage(split.where(F.col("split") == "train").drop("split"))


@register("undersample_scaled", _sql(*_PRE_CTES, S.split_cte("pre"), "trn AS (SELECT * FROM spl WHERE split = 'train')",
                                     S.take_cte("trn", "und", """CASE WHEN q.lbl = (SELECT lbl FROM und_cc ORDER BY n_c, lbl LIMIT 1)
    THEN q.n_c ELSE least(q.n_c, CAST(trunc((SELECT min(n_c) FROM und_cc) / 0.1) AS BIGINT)) END"""),
                                     body=f"SELECT row_key, {_R_FEATS}, isFraud FROM und"))
def q_undersample_scaled(spark, sf_dir):
    out = balance(_scaled_train(spark, sf_dir), MANAGER_FEATURE_COLS, "undersampling")
    return _round_cols(out, MANAGER_FEATURE_COLS)


# Membership of neighbours is decided on values rounded alike on both sides:
# standardised sums may differ in the last bit between engines.
@register("smote_scaled", _sql(*_PRE_CTES, S.split_cte("pre"), f"""
trn AS (SELECT row_key, {_R_FEATS}, isFraud FROM spl WHERE split = 'train'),
""" + _SMOTE_CTES.format(distance_cols_a=S.cols(MANAGER_FEATURE_COLS, "a."), distance_cols_b=S.cols(MANAGER_FEATURE_COLS, "b."))
    + "syn AS (SELECT -(g.i + 1) AS row_key, " + ", ".join(
        f"b.{c} + g.gap * (n.{c} - b.{c}) AS {c}" for c in MANAGER_FEATURE_COLS) + _SMOTE_FROM,
    body=f"SELECT row_key, {_R_FEATS}, isFraud FROM trn UNION ALL SELECT row_key, {_R_FEATS}, isFraud FROM syn"))
def q_smote_scaled(spark, sf_dir):
    train = _round_cols(_scaled_train(spark, sf_dir), MANAGER_FEATURE_COLS)
    return _round_cols(balance(train, MANAGER_FEATURE_COLS, "SMOTE"), MANAGER_FEATURE_COLS)


# ---------------------------------------------------------------- profile of the source columns
TARGET_CORR_COLS = ["step", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest", "isFraud"]


@register("corr_source", _sql(S.TX, S.long_cte("tx", TARGET_CORR_COLS), body="""
SELECT a.feature AS a, b.feature AS b, round(CASE WHEN min(a.x) = max(a.x) OR min(b.x) = max(b.x) THEN NULL
  ELSE covar_samp(a.x, b.x) / (stddev_samp(a.x) * stddev_samp(b.x)) END, 6) AS corr
FROM lng a JOIN lng b ON a.row_key = b.row_key WHERE a.x IS NOT NULL AND b.x IS NOT NULL GROUP BY a.feature, b.feature"""))
def q_corr_source(spark, sf_dir):
    return _round_cols(st.corr_long(src.load_tx(spark, sf_dir), TARGET_CORR_COLS), ["corr"])


_BALANCES = ["amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]


@register("describe_balances", _sql(S.TX, S.long_cte("tx", _BALANCES), body="""
SELECT feature, count(x) AS count, round(round(avg(x), 6), 2) AS mean, round(round(stddev_samp(x), 6), 2) AS std,
  round(min(x), 2) AS min, round(round(quantile_cont(x, 0.25), 6), 2) AS p25, round(round(quantile_cont(x, 0.5), 6), 2) AS p50,
  round(round(quantile_cont(x, 0.75), 6), 2) AS p75, round(max(x), 2) AS max
FROM lng GROUP BY feature"""))
def q_describe_balances(spark, sf_dir):
    d = st.describe(src.load_tx(spark, sf_dir), _BALANCES)
    return d.withColumns({c: F.round(r6(c), 2) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")})


# ---------------------------------------------------------------- resampling summary (A10), kNN on transactions
@register("resample_summary", _sql(S.TX, S.features_cte(), S.split_cte("feat"), """
trn AS (SELECT * FROM spl WHERE split = 'train'),
cnt AS (SELECT count(*) FILTER (WHERE isFraud = 0) AS n0, count(*) FILTER (WHERE isFraud = 1) AS n1 FROM trn),
st AS (SELECT 'before' AS stage, n0, n1 FROM cnt
  UNION ALL SELECT 'smote', n0, CAST(trunc(0.1 * n0) AS BIGINT) FROM cnt
  UNION ALL SELECT 'undersampling', least(n0, CAST(trunc(n1 / 0.1) AS BIGINT)), n1 FROM cnt)""", body="""
SELECT stage, 0 AS isFraud, n0 AS count, round(n0 * 100.0 / (n0 + n1), 6) AS pct FROM st
UNION ALL SELECT stage, 1, n1, round(n1 * 100.0 / (n0 + n1), 6) FROM st"""))
def q_resample_summary(spark, sf_dir):
    """A10: class counts and shares before and after each rebalancing."""
    train = _split(spark, sf_dir).where(F.col("split") == "train").drop("split")
    stages = {"before": train, "smote": smote(train, FEATURE_COLS), "undersampling": sa.undersample(train)}
    out = None
    for name, df in stages.items():
        part = st.class_shares(df).select(F.lit(name).alias("stage"), LABEL, "count", "pct")
        out = part if out is None else out.unionByName(part)
    return _round_cols(out, ["pct"])


def _scaled_cte() -> str:
    fs = MANAGER_FEATURE_COLS
    return ("mst AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in fs)
            + " FROM feat),\nsfeat AS (SELECT f.row_key, " + ", ".join(
                f"(f.{c} - mst.m_{c}) / coalesce(nullif(mst.s_{c}, 0), 1) AS {c}" for c in fs)
            + ", f.isFraud FROM feat f, mst)")


_VEC = "[" + ", ".join(MANAGER_FEATURE_COLS) + "]::DOUBLE[]"


@register("knn_tx", _sql(S.TX, S.features_cte(), _scaled_cte(), S.split_cte("sfeat"),
                         "trn AS (SELECT * FROM spl WHERE split = 'train')",
                         "tst AS (SELECT * FROM spl WHERE split = 'test')",
                         S.take_cte("trn", "str", "2500"), f"""
kq AS (SELECT row_key AS qid, {_VEC} AS v, isFraud AS truth FROM tst),
kt AS (SELECT row_key AS tid, {_VEC} AS v, isFraud AS label FROM str),
kd AS (SELECT q.qid, q.truth, t.tid, t.label, list_distance(q.v, t.v) AS distance FROM kq q, kt t),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, tid) AS rank FROM kd)
  WHERE rank <= 5),
{S.NNW_EPS},
{S.vote_sql('w')},
pred AS (SELECT q.qid AS row_key, q.truth AS label, pr.prediction FROM kq q JOIN pr ON pr.qid = q.qid),
{S.METRIC_CTES}""", body=f"""
SELECT round((SELECT sum(tp) / sum(support) FROM pc), 6) AS accuracy,
  round({S.avg_sql('precision', 'binary')}, 6) AS precision, round({S.avg_sql('recall', 'binary')}, 6) AS recall,
  round({S.avg_sql('f1', 'binary')}, 6) AS f1"""))
def q_knn_tx(spark, sf_dir):
    """Hand-written kNN: manager scaling (fit on all rows), stratified split, at
    most 2,500 train rows per class (the study's bound on labelled fitting
    rows), every test row scored, euclidean, distance weights."""
    f = _feat(spark, sf_dir)
    f = sc.apply_scaler(f, sc.fit_scaler(f, MANAGER_FEATURE_COLS))
    s = cut_lineage(sa.stratified_split(f))
    tr = sa.balanced_sample(s.where(F.col("split") == "train"), 2500)
    te = s.where(F.col("split") == "test")
    vec = F.array(*[F.col(c) for c in MANAGER_FEATURE_COLS])
    nn = kn.knn_join(te.select(F.col(KEY).alias("qid"), vec.alias("vec")),
                     tr.select(F.col(KEY).alias("tid"), vec.alias("vec"), F.col(LABEL).alias("label")),
                     5, "euclidean", label="label")
    pred = cut_lineage(kn.knn_predict(nn, "distance", "eps").join(
        te.select(F.col(KEY).alias("qid"), F.col(LABEL).alias("label")), "qid"))
    row = me.report_row(pred, score=None, pos_label=1).drop("roc_auc")
    return _round_cols(row, ["accuracy", "precision", "recall", "f1"])


@register("knn_estimator", ORACLE["knn_tx"])
def q_knn_estimator(spark, sf_dir):
    """F3 + M9: the kNN join as an estimator, evaluated like any model (the rows
    of ``knn_tx``)."""
    f = _feat(spark, sf_dir)
    f = sc.apply_scaler(f, sc.fit_scaler(f, MANAGER_FEATURE_COLS))
    s = cut_lineage(sa.stratified_split(f))
    tr = sa.balanced_sample(s.where(F.col("split") == "train"), 2500)
    knn = es.KNNJoinClassifier(weights="distance", weightMode="eps", idCol=KEY)
    train, test = (mo.assemble(df.withColumnRenamed(LABEL, "label"), MANAGER_FEATURE_COLS)
                   for df in (tr, s.where(F.col("split") == "test")))
    row = pl.evaluate_model("kNN", knn, train, test)
    return _round_cols(row.select("accuracy", "precision", "recall", "f1"), ["accuracy", "precision", "recall", "f1"])


_NEWTON_STEPS = 20
_STANDARD = ", ".join(f"(s.{c} - st.m_{c}) / coalesce(nullif(st.s_{c}, 0), 1) AS x{i}" for i, c in enumerate(FEATURE_COLS, 1))
_XS = ", ".join(f"x{i}" for i in range(1, len(FEATURE_COLS) + 2))
_STUDY_CTES = (S.TX, S.features_cte(), S.split_cte("feat"), f"""
st AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in FEATURE_COLS)} FROM spl WHERE split = 'train'),
wt AS (SELECT isFraud AS y, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS w FROM spl WHERE split = 'train'
  GROUP BY isFraud),
std AS (SELECT s.row_key, s.split, s.isFraud AS y, wt.w, {_STANDARD}, 1.0 AS x{len(FEATURE_COLS) + 1}
  FROM spl s JOIN wt ON wt.y = s.isFraud, st)""")


def _dot(xs, b: str = "b") -> str:
    return "1 / (1 + exp(-(" + " + ".join(f"{x} * {b}[{i}]" for i, x in enumerate(xs, 1)) + ")))"


_LOGIT = _dot([f"x{i}" for i in range(1, len(FEATURE_COLS) + 2)])
_LR_CTES = (*_STUDY_CTES, f"""
fits AS (SELECT 0 AS g, y, w, {_XS} FROM std WHERE split = 'train')""",
            S.newton_cte("fits", len(FEATURE_COLS) + 1, "nw", _NEWTON_STEPS))


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@register("lr_newton", _recursive(_sql(*_LR_CTES, f"""
preds AS (SELECT 'Logistic Regression' AS model, y AS label, CAST({_LOGIT} > 0.5 AS INTEGER) AS prediction,
  {_LOGIT} AS score FROM std, nw WHERE split = 'test' AND step = {_NEWTON_STEPS})""", _BOARD.rstrip(), body="SELECT * FROM board")))
def q_lr_newton(spark, sf_dir):
    """M1 by aggregation: the metrics row of the Newton fit (``lr`` is the library's)."""
    study = _study(spark, sf_dir)
    train, test = study.frames(True)
    row = pl.evaluate_model("Logistic Regression", es.NewtonLogisticRegression(weightCol="weight"), train, test)
    return _round_cols(row.drop("train_seconds"), ["accuracy", "precision", "recall", "f1", "roc_auc"])


@register("lr_newton_scores", _recursive(_sql(*_LR_CTES, body=f"""
SELECT row_key, y AS label, CAST({_LOGIT} > 0.5 AS INTEGER) AS prediction, round({_LOGIT}, 6) AS score
FROM std, nw WHERE split = 'test' AND step = {_NEWTON_STEPS}""")))
def q_lr_newton_scores(spark, sf_dir):
    """M1 by aggregation: P(1) of every test row."""
    train, test = _study(spark, sf_dir).frames(True)
    out = mo.predict_binary(es.NewtonLogisticRegression(weightCol="weight").fit(train), test)
    return out.select(KEY, "label", "prediction", r6("score").alias("score"))


def _stacking_closed_sql() -> str:
    """Fits 0-2 leave one fold out, fit 3 takes all train rows."""
    d = len(FEATURE_COLS)
    xs = [f"x{i}" for i in range(1, d + 1)]
    stat = ", ".join(f"avg({x}) AS m{x}, var_pop({x}) + any_value(eps) AS v{x}" for x in xs)
    log = " - ".join(["ln(prior)", *[f"0.5 * ln(2 * pi() * v{x}) - ({x} - m{x}) * ({x} - m{x}) / (2 * v{x})" for x in xs]])
    folds = ORACLE["folds"]
    fold = folds[folds.index("trn AS ("):].replace("SELECT row_key, isFraud, CAST(CASE WHEN rn", "fld AS (SELECT row_key, CAST(CASE WHEN rn")
    ctes, body = fold.split("fld AS (", 1)
    return _recursive(_sql(*_STUDY_CTES, ctes.rstrip().rstrip(",") + ",\nfld AS (" + body + ")", f"""
fits AS (SELECT g, y, w, {_XS} FROM std JOIN fld USING (row_key), range(4) q(g) WHERE fold <> g)""",
                           S.newton_cte("fits", d + 1, "nw", _NEWTON_STEPS), f"""
asked AS (SELECT coalesce(fold, 3) AS g, std.* FROM std LEFT JOIN fld USING (row_key)),
eps AS (SELECT g, count(*) AS n, 1e-9 * greatest({', '.join(f'var_pop({x})' for x in xs)}) AS eps FROM fits GROUP BY g),
nb AS (SELECT g, y AS c, count(*) / any_value(n) AS prior, {stat} FROM fits JOIN eps USING (g) GROUP BY g, y),
jl AS (SELECT row_key, c, {log} AS j FROM asked JOIN nb USING (g)),
pb AS (SELECT row_key, sum(CASE WHEN c = 1 THEN exp(j - top) END) / sum(exp(j - top)) AS p_nb
  FROM (SELECT *, max(j) OVER (PARTITION BY row_key) AS top FROM jl) GROUP BY row_key),
scored AS (SELECT row_key, split, a.y, {_LOGIT} AS p_lr, p_nb FROM asked a JOIN nw ON nw.g = a.g AND step = {_NEWTON_STEPS}
  JOIN pb USING (row_key)),
mrows AS (SELECT 0 AS g, y, 1.0 AS w, p_lr AS x1, p_nb AS x2, 1.0 AS x3 FROM scored WHERE split = 'train')""",
                           S.newton_cte("mrows", 3, "meta", _NEWTON_STEPS), body=f"""
SELECT row_key, y AS label, CAST({_dot(['p_lr', 'p_nb', '1.0'])} > 0.5 AS INTEGER) AS prediction,
  round({_dot(['p_lr', 'p_nb', '1.0'])}, 5) AS score
FROM scored, meta WHERE split = 'test' AND step = {_NEWTON_STEPS}"""))


@register("stacking_closed", _stacking_closed_sql())
def q_stacking_closed(spark, sf_dir):
    """M7 over bases fitted by aggregations: Newton logistic regression and
    closed-form naive Bayes, 3 folds, a Newton logistic regression on top."""
    train, test = _study(spark, sf_dir).frames(True)
    out = en.stacking(train, test, pl.closed_bases(), lambda n: es.NewtonLogisticRegression(), key=KEY)
    return out.select(KEY, "label", "prediction", r6("score", 5).alias("score"))


def _gini_sql(pos: str, neg: str) -> str:
    share = f"coalesce(({pos}) / nullif(({pos}) + ({neg}), 0), 0.0)"
    return f"2.0 * {share} * (1.0 - {share})"


def _exact_tree_ctes(depth: int, start: str, per_split: int | None = None, weighted: bool = True) -> list[str]:
    """Level by level, the same search over distinct values, from ``start`` rows
    (node, m, y, row_key, features; m = how often a row counts, 0: it is only
    scored): ``nodes``, the node table, and ``leaves``, every row's leaf."""
    fs, ctes, out, leaves = FEATURE_COLS, [start], [], []
    whole = _gini_sql("P * w1", "N * w0")
    for k in range(depth + 1):
        ctes.append(f"n{k} AS (SELECT node, sum(y * m) AS P, sum((1 - y) * m) AS N FROM r{k} WHERE m > 0 GROUP BY node)")
        names = f"CASE f {' '.join(f'WHEN {i} THEN {c!r}' for i, c in enumerate(fs))} END"
        if k == depth:
            out.append(f"SELECT node, {k} AS depth, NULL AS feature, NULL AS threshold, P, N, NULL AS g FROM n{k}")
            leaves.append(f"SELECT row_key, y, m, P, N FROM r{k} JOIN n{k} USING (node)")
            continue
        long = " UNION ALL ".join(f"SELECT node, y, m, {i} AS f, CAST({c} AS DOUBLE) AS s FROM r{k} WHERE m > 0" for i, c in enumerate(fs))
        tried = "" if per_split is None else f"JOIN t{k} USING (node, f) "
        left, rest = "pb * w1 + nb * w0", "(P - pb) * w1 + (N - nb) * w0"
        total = "(P * w1 + N * w0)"
        if per_split is not None:
            ctes.append(f"""t{k} AS (SELECT node, f FROM n{k}, range({len(fs)}) q(f)
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY md5(concat(node, ':', f, ':42')), f) <= {per_split})""")
        ctes += [f"c{k} AS (SELECT node, f, s, sum(y * m) AS pos, sum((1 - y) * m) AS neg FROM ({long}) {tried}GROUP BY node, f, s)", f"""
b{k} AS (SELECT node, f, s, lag(s) OVER (PARTITION BY node, f ORDER BY s) AS low,
  sum(pos) OVER (PARTITION BY node, f ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pb,
  sum(neg) OVER (PARTITION BY node, f ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nb FROM c{k})""", f"""
g{k} AS (SELECT node, f, (low + s) / 2 AS t, round({whole} - ({left}) / {total} * {_gini_sql('pb * w1', 'nb * w0')}
  - ({rest}) / {total} * {_gini_sql('(P - pb) * w1', '(N - nb) * w0')}, {et.PLACES}) AS g FROM b{k} JOIN n{k} USING (node), wt
  WHERE low IS NOT NULL)""", f"""
s{k} AS (SELECT * FROM g{k} WHERE g > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY g DESC, f, t) = 1)""", f"""
r{k + 1} AS (SELECT 2 * node + CASE WHEN CASE f {' '.join(f'WHEN {i} THEN CAST({c} AS DOUBLE)' for i, c in enumerate(fs))} END <= t
  THEN 0 ELSE 1 END AS node, m, y, row_key, {S.cols(fs)} FROM r{k} JOIN s{k} USING (node))"""]
        out.append(f"SELECT node, {k} AS depth, {names} AS feature, t AS threshold, P, N, g FROM n{k} LEFT JOIN s{k} USING (node)")
        leaves.append(f"SELECT row_key, y, m, P, N FROM r{k} JOIN n{k} USING (node) WHERE node NOT IN (SELECT node FROM s{k})")
    wt = """wt AS (SELECT count(*) / (2.0 * count(*) FILTER (isFraud = 0)) AS w0,
  count(*) / (2.0 * count(*) FILTER (isFraud = 1)) AS w1 FROM spl WHERE split = 'train')""" if weighted else \
        "wt AS (SELECT 1.0 AS w0, 1.0 AS w1)"
    return [S.TX, S.features_cte(), S.split_cte("feat"), wt, *ctes, f"nodes AS ({' UNION ALL '.join(out)})",
            f"leaves AS ({' UNION ALL '.join(leaves)})"]


def _one_root(what: str) -> str:
    return f"r0 AS (SELECT CAST(1 AS BIGINT) AS node, {what} AS m, isFraud AS y, row_key, {S.cols(FEATURE_COLS)} FROM spl)"


_TREE_DEPTH, _FOREST_TREES, _FOREST_DEPTH, _PER_SPLIT = 3, 5, 3, 3
_SINGLE = _one_root("CASE WHEN split = 'train' THEN 1 ELSE 0 END")
_BAGGED = f"""r0 AS (SELECT {et.first_root(_FOREST_TREES)} + t AS node, CASE WHEN split = 'test' THEN 0
    ELSE {' + '.join(f"CAST(u >= {c!r} AS BIGINT)" for c in et.poisson_steps())} END AS m, isFraud AS y, row_key,
  {S.cols(FEATURE_COLS)} FROM (SELECT *, {S.u_sql('row_key', "tree' || t || '")} AS u FROM spl, range({_FOREST_TREES}) q(t)))"""
_TREE_CTES = _exact_tree_ctes(_TREE_DEPTH, _SINGLE)
_FOREST_CTES = _exact_tree_ctes(_FOREST_DEPTH, _BAGGED, _PER_SPLIT)
_NODES_SQL = f"""
SELECT node, CAST(depth AS INTEGER) AS depth, feature, round(threshold, 6) AS threshold, CAST(P + N AS BIGINT) AS n,
  CAST(P AS BIGINT) AS positives, round({_gini_sql('P * w1', 'N * w0')}, 6) AS impurity, round(g, 6) AS gain
FROM nodes, wt"""
_LEAF_SCORES_SQL = """
SELECT row_key, y AS label, CAST(CASE WHEN avg(P * w1 / (P * w1 + N * w0)) > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction,
  round(avg(P * w1 / (P * w1 + N * w0)), 6) AS score FROM leaves, wt
WHERE row_key IN (SELECT row_key FROM spl WHERE split = 'test') GROUP BY row_key, y"""
_SHARES_SQL = f"""
SELECT f.feature, round(coalesce(v / sum(v) OVER (), 0.0), 6) AS importance
FROM (VALUES {', '.join(f"('{c}')" for c in FEATURE_COLS)}) f(feature) LEFT JOIN (
  SELECT feature, sum(share) AS v FROM (SELECT feature, v / sum(v) OVER (PARTITION BY tree) AS share FROM (
    SELECT node >> depth AS tree, feature, sum(g * (P * w1 + N * w0)) AS v FROM nodes, wt
    WHERE feature IS NOT NULL GROUP BY 1, 2)) GROUP BY feature) USING (feature)"""


def _weighted_split(spark, sf_dir):
    """Train and test rows, and the balanced weights of class 0 and 1."""
    rows = cut_lineage(pl.dealt(_split(spark, sf_dir)))
    train = rows.where(F.col("split") == "train")
    n = {r[0]: r[1] for r in train.groupBy(LABEL).count().collect()}
    return train, rows.where(F.col("split") == "test"), tuple(sum(n.values()) / (2.0 * n[c]) for c in (0, 1))


def _exact_forest(spark, sf_dir):
    train, test, w = _weighted_split(spark, sf_dir)
    return et.fit_exact_forest(train, FEATURE_COLS, LABEL, _FOREST_TREES, _FOREST_DEPTH, w, per_split=_PER_SPLIT, key=KEY), test, w


@register("exact_tree", _sql(*_TREE_CTES, body=_NODES_SQL))
def q_exact_tree(spark, sf_dir):
    """M2/M18 with exact splits: the first levels of the class-weighted tree."""
    train, _, w = _weighted_split(spark, sf_dir)
    return _round_cols(et.fit_exact_tree(train, FEATURE_COLS, LABEL, _TREE_DEPTH, w), ["threshold", "impurity", "gain"])


@register("exact_tree_scores", _sql(*_TREE_CTES, body=_LEAF_SCORES_SQL))
def q_exact_tree_scores(spark, sf_dir):
    """M2 + M11: P(1) of every test row by the exact tree."""
    train, test, w = _weighted_split(spark, sf_dir)
    out = et.predict_exact_tree(et.fit_exact_tree(train, FEATURE_COLS, LABEL, _TREE_DEPTH, w), test, FEATURE_COLS, w)
    return out.select(KEY, F.col(LABEL).alias("label"), "prediction", r6("score").alias("score"))


@register("exact_importances", _sql(*_TREE_CTES, body=_SHARES_SQL))
def q_exact_importances(spark, sf_dir):
    """M12 + K2: importances of the exact tree."""
    train, _, w = _weighted_split(spark, sf_dir)
    nodes = et.fit_exact_tree(train, FEATURE_COLS, LABEL, _TREE_DEPTH, w)
    return _round_cols(et.exact_importances(nodes, FEATURE_COLS, 12, w), ["importance"])


@register("exact_forest", _sql(*_FOREST_CTES, body=_NODES_SQL))
def q_exact_forest(spark, sf_dir):
    """M4/M18 with exact splits: the nodes of five bootstrapped trees."""
    return _round_cols(_exact_forest(spark, sf_dir)[0], ["threshold", "impurity", "gain"])


@register("exact_forest_scores", _sql(*_FOREST_CTES, body=_LEAF_SCORES_SQL))
def q_exact_forest_scores(spark, sf_dir):
    """M4 + M11: mean leaf share over the trees for every test row."""
    nodes, test, w = _exact_forest(spark, sf_dir)
    out = et.predict_exact_tree(nodes, test, FEATURE_COLS, w)
    return out.select(KEY, F.col(LABEL).alias("label"), "prediction", r6("score").alias("score"))


@register("exact_forest_importances", _sql(*_FOREST_CTES, body=_SHARES_SQL))
def q_exact_forest_importances(spark, sf_dir):
    """M12 + K2: mean importances over the trees of the forest."""
    nodes, _, w = _exact_forest(spark, sf_dir)
    return _round_cols(et.exact_importances(nodes, FEATURE_COLS, 12, w), ["importance"])


_BOOST = {"rounds": 4, "depth": 3, "rate": 0.1}         # the first rounds of the study's boosting, at half its depth


def _boosting_ctes(rounds: int, depth: int, rate: float) -> list[str]:
    """Rounds r, levels k: z{r}_{k} rows with their node; ``nodes``; ``m{rounds}`` the margins."""
    fs, out = FEATURE_COLS, []
    unit = 2 ** bo.SCALE_BITS
    ctes = [S.TX, S.features_cte(), S.split_cte("feat"), f"""
pw AS (SELECT count(*) FILTER (isFraud = 0) / count(*) FILTER (isFraud = 1) AS pw FROM spl WHERE split = 'train'),
m0 AS MATERIALIZED (SELECT row_key, isFraud AS y, split, CASE WHEN isFraud = 1 THEN pw ELSE 1.0 END AS w, CAST(0 AS DOUBLE) AS mg,
  {S.cols(fs)} FROM spl, pw),
tw AS (SELECT sum(w) AS total FROM m0 WHERE split = 'train')"""]
    names = f"CASE f {' '.join(f'WHEN {i} THEN {c!r}' for i, c in enumerate(fs))} END"
    value = f"CASE f {' '.join(f'WHEN {i} THEN CAST({c} AS DOUBLE)' for i, c in enumerate(fs))} END"

    def real(c):
        return f"(CAST({c} AS DOUBLE) / {unit})"

    for r in range(rounds):
        p = "CASE WHEN mg >= 0 THEN 1 / (1 + exp(-mg)) ELSE exp(mg) / (1 + exp(mg)) END"
        ctes.append(f"""z{r}_0 AS MATERIALIZED (SELECT *, CAST(1 AS BIGINT) AS node, CAST(round(w * (p - y) * {unit}) AS BIGINT) AS g,
  CAST(round(w * p * (1.0 - p) * {unit}) AS BIGINT) AS h FROM (SELECT *, {p} AS p FROM m{r}))""")
        for k in range(depth):
            a = f"{r}_{k}"
            rows = f"FROM z{a} WHERE split = 'train' AND node >= {2 ** k}"
            long = " UNION ALL ".join(f"SELECT node, g, h, {i} AS f, CAST({c} AS DOUBLE) AS s {rows}" for i, c in enumerate(fs))
            gl, hl, g, h = real("gb"), real("hb"), real("n.G"), real("n.H")
            gain = f"{gl} * {gl} / ({hl} + 1.0) + ({g} - {gl}) * ({g} - {gl}) / ({h} - {hl} + 1.0) - {g} * {g} / ({h} + 1.0)"
            ctes.append(f"""n{a} AS (SELECT node, sum(g) AS G, sum(h) AS H {rows} GROUP BY node),
c{a} AS (SELECT node, f, s, sum(g) AS gs, sum(h) AS hs FROM ({long}) GROUP BY node, f, s),
b{a} AS (SELECT node, f, s, lag(s) OVER (PARTITION BY node, f ORDER BY s) AS low,
  sum(gs) OVER (PARTITION BY node, f ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gb,
  sum(hs) OVER (PARTITION BY node, f ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hb FROM c{a}),
s{a} AS MATERIALIZED (SELECT * FROM (SELECT node, f, (low + s) / 2 AS t, round(({gain}) / total, {et.PLACES}) AS gain
    FROM b{a} JOIN n{a} n USING (node), tw WHERE low IS NOT NULL AND {hl} >= 1 AND {h} - {hl} >= 1) WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, t) = 1),
z{r}_{k + 1} AS MATERIALIZED (SELECT z.* REPLACE (CASE WHEN s.node IS NULL THEN z.node WHEN {value} <= t THEN 2 * z.node
  ELSE 2 * z.node + 1 END AS node) FROM z{a} z LEFT JOIN s{a} s ON s.node = z.node)""")
            out.append(f"""SELECT {r} AS tree, node, {k} AS depth, {names} AS feature, t AS threshold, gain, {real('H')} AS weight,
  CASE WHEN f IS NULL THEN {-rate} * {real('G')} / ({real('H')} + 1.0) END AS value FROM n{a} LEFT JOIN s{a} USING (node)""")
        ctes.append(f"""v{r} AS MATERIALIZED (SELECT node, sum(g) AS G, sum(h) AS H FROM z{r}_{depth} WHERE split = 'train' GROUP BY node),
m{r + 1} AS MATERIALIZED (SELECT row_key, y, split, w, mg + {-rate} * {real('v.G')} / ({real('v.H')} + 1.0) AS mg, {S.cols(fs)}
  FROM z{r}_{depth} JOIN v{r} v USING (node))""")
        out.append(f"""SELECT {r}, node, {depth}, NULL, NULL, NULL, {real('H')}, {-rate} * {real('G')} / ({real('H')} + 1.0)
  FROM v{r} WHERE node >= {2 ** depth}""")
    return [*ctes, f"nodes AS ({' UNION ALL '.join(out)})"]


_BOOST_CTES = _boosting_ctes(**_BOOST)


def _boosted(spark, sf_dir):
    rows = cut_lineage(_split(spark, sf_dir))
    train = rows.where(F.col("split") == "train")
    weight = st.pos_weight(train, LABEL).first()["pos_weight"]
    return bo.fit_newton_boosting(train, FEATURE_COLS, LABEL, pos_weight=weight, **_BOOST), rows.where(F.col("split") == "test")


@register("newton_boosting", _sql(*_BOOST_CTES, body="""
SELECT CAST(tree AS INTEGER) AS tree, node, CAST(depth AS INTEGER) AS depth, feature, round(threshold, 6) AS threshold,
  round(gain, 6) AS gain, round(weight, 5) AS weight, round(value, 6) AS value FROM nodes"""))
def q_newton_boosting(spark, sf_dir):
    """M5/M18 by aggregations: the nodes of the first boosted trees, positives weighted n0 / n1."""
    nodes = _boosted(spark, sf_dir)[0]
    return _round_cols(nodes.withColumn("weight", r6("weight", 5)), ["threshold", "gain", "value"])


@register("newton_boosting_scores", _sql(*_BOOST_CTES, body=f"""
SELECT row_key, y AS label, CAST(mg > 0 AS INTEGER) AS prediction, round(1 / (1 + exp(-mg)), 6) AS score
FROM m{_BOOST['rounds']} WHERE split = 'test'"""))
def q_newton_boosting_scores(spark, sf_dir):
    """M5 + M11: P(1) of every test row by the boosted trees."""
    nodes, test = _boosted(spark, sf_dir)
    out = bo.predict_newton_boosting(nodes, test.select(KEY, LABEL, *FEATURE_COLS), FEATURE_COLS)
    return out.select(KEY, F.col(LABEL).alias("label"), "prediction", r6("score").alias("score"))


def _balanced_sql(rows: str, source: str) -> str:
    """Scores of the test rows by a tree on ``source``, made by the CTEs ``rows``."""
    start = f"""r0 AS (WITH trn AS (SELECT * FROM spl WHERE split = 'train'),{rows}
given AS (SELECT * FROM {source})
  SELECT CAST(1 AS BIGINT) AS node, 1 AS m, isFraud AS y, row_key, {S.cols(FEATURE_COLS)} FROM given
  UNION ALL SELECT 1, 0, isFraud, row_key, {S.cols(FEATURE_COLS)} FROM spl WHERE split = 'test')"""
    return _sql(*_exact_tree_ctes(_TREE_DEPTH, start, weighted=False), body=_LEAF_SCORES_SQL)


_SYNTHETIC = _SMOTE_SQL[_SMOTE_SQL.index("trn AS ("):_SMOTE_SQL.rindex("SELECT row_key, ", 0, _SMOTE_SQL.rindex("UNION ALL"))]
_SYNTHETIC = _SYNTHETIC.split("\n", 1)[1].rstrip() + ","
_UNDER = ORACLE["undersample"]
_UNDER = _UNDER[_UNDER.index("und_cc AS ("):_UNDER.rindex("SELECT row_key")].rstrip() + ","
_BALANCED_PREDS = " UNION ALL ".join(
    f"SELECT '{name}' AS model, * FROM ({sql})" for name, sql in zip(pl.BALANCING_NAMES, (
        _sql(*_TREE_CTES, body=_LEAF_SCORES_SQL),
        _balanced_sql("\n" + _SYNTHETIC, f"(SELECT row_key, isFraud, {S.cols(FEATURE_COLS)} FROM trn UNION ALL "
                      f"SELECT row_key, isFraud, {S.cols(FEATURE_COLS)} FROM syn)"),
        _balanced_sql("\n" + _UNDER, "und"))))


@register("balancing_exact", _sql(f"preds AS ({_BALANCED_PREDS})", _BOARD.rstrip(), body="SELECT model, precision, recall, f1 FROM board"))
def q_balancing_exact(spark, sf_dir):
    """M15 on exact trees: class weights, SMOTE and undersampling compared."""
    train, test, w = _weighted_split(spark, sf_dir)
    train = train.drop("split")
    one = (1.0, 1.0)
    fits = zip(pl.BALANCING_NAMES, ((train, w), (smote(train, FEATURE_COLS), one), (sa.undersample(train), one)))
    preds = {}
    for name, (rows, weights) in fits:
        nodes = et.fit_exact_tree(rows, FEATURE_COLS, LABEL, _TREE_DEPTH, weights)
        pred = et.predict_exact_tree(nodes, test, FEATURE_COLS, weights)
        preds[name] = (pred.select(F.col(LABEL).alias("label"), "prediction", r6("score").alias("score")), None)
    return _round_cols(pl.balancing_comparison(pl.evaluate_all(preds)), ["precision", "recall", "f1"])
