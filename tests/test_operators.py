"""Hand-computed frames for the semantic traps (SURVEY T-rows) and
properties of the distributed operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from txrisk.functions.quantile import exact_percentile_wide
from txrisk.operators import features as fe
from txrisk.operators import knn as kn
from txrisk.operators import metrics as me
from txrisk.operators import sampling as sa
from txrisk.operators import scaling as sc
from txrisk.operators import stats as st
from txrisk.operators.smote import smote
from txrisk.schema import FEATURE_COLS
from txrisk.sources import transactions as src


# ---------------------------------------------------------------- pure helpers
def test_largest_remainder_and_split_quotas():
    assert sa.largest_remainder({0: 5, 1: 5}, 5) == {0: 3, 1: 2}      # tie -> smaller class
    q = sa.split_quotas({0: 9809, 1: 191}, 0.2)
    assert sum(q.values()) == math.ceil(0.2 * 10000)
    assert q == {0: 1962, 1: 38}


def test_fold_bounds_follow_round_robin_layout():
    b = sa.unshuffled_fold_bounds({0: 4, 1: 5}, 3)
    assert b[0] == [2, 3]            # sizes 2, 1, 1
    assert b[1] == [1, 3]            # positions 4..8: fold0 {6}, fold1 {4, 7}, fold2 {5, 8}
    # recompute directly
    y = [0] * 4 + [1] * 5
    alloc = [[sum(1 for p in range(i, len(y), 3) if y[p] == c) for c in (0, 1)] for i in range(3)]
    assert b[1] == [alloc[0][1], alloc[0][1] + alloc[1][1]]


# ---------------------------------------------------------------- features
def test_type_codes_alphabetical_and_null_kept(spark):
    df = spark.createDataFrame([("TRANSFER",), ("CASH_IN",), (None,), ("PAYMENT",)], "type string")
    cats = fe.fit_type_codes(df)
    assert cats == ["CASH_IN", "PAYMENT", "TRANSFER"]
    got = {r["type"]: r["type_encoded"] for r in fe.apply_type_codes(df, cats).collect()}
    assert got == {"CASH_IN": 0, "PAYMENT": 1, "TRANSFER": 2, None: 3}


def test_flags_treat_null_as_false(spark):
    df = spark.createDataFrame([(None, 0.0, None, 1.0, 1.0, 1.0, 1.0)],
                               "type string, amount double, oldbalanceOrg double, newbalanceOrig double, "
                               "oldbalanceDest double, newbalanceDest double, x double")
    r = df.withColumns(fe.derived_columns()).first()
    assert r["orig_zeroed"] == 0 and r["suspicious_type"] == 0


def test_risk_category_null_amount_on_fraud_is_large(spark):
    df = spark.createDataFrame([(0, 5.0), (1, 5.0), (1, 50.0), (1, None), (None, 1.0)],
                               "isFraud int, amount double")
    got = [r[0] for r in df.select(fe.risk_category_expr(10.0)).collect()]
    assert got == [0, 1, 2, 2, 1]


# ---------------------------------------------------------------- stats
def test_exact_percentiles_gk_band_path(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=30000).round(3)
    df = spark.createDataFrame([(float(v), int(i % 2)) for i, v in enumerate(x)], "x double, g int")
    ps = [0.0, 0.1, 0.5, 0.99, 1.0]
    got = exact_percentile_wide(df, "x", ps, by=["g"], accuracy=200).orderBy("g").toPandas()
    for g in (0, 1):
        want = np.quantile(x[g::2], ps)
        assert np.allclose(got.iloc[g, 1:].to_numpy(dtype=float), want, rtol=0, atol=1e-12)


def test_scaler_uses_population_std_and_zero_std_divides_by_one(spark):
    df = spark.createDataFrame([(1.0, 3.0), (3.0, 3.0)], "a double, b double")
    stats = sc.fit_scaler(df, ["a", "b"])
    assert stats["a"] == (2.0, 1.0)
    rows = sc.apply_scaler(df, stats).collect()
    assert [r["a"] for r in rows] == [-1.0, 1.0] and [r["b"] for r in rows] == [0.0, 0.0]


def test_corr_constant_column_is_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, None)], "a double, b double")
    got = {(r["a"], r["b"]): r["corr"] for r in st.corr_long(df, ["a", "b"]).collect()}
    assert got[("a", "b")] is None and got[("b", "b")] is None and abs(got[("a", "a")] - 1) < 1e-12


# ---------------------------------------------------------------- sampling
def test_split_exact_counts_and_partition_independent(spark):
    tx = src.load_tx(spark, SF_CHECK)
    a = sa.stratified_split(tx).where("split = 'test'").select("row_key")
    b = sa.stratified_split(tx.repartition(7)).where("split = 'test'").select("row_key")
    assert a.count() == 2000
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    per = {r["isFraud"]: r["count"] for r in
           sa.stratified_split(tx).where("split = 'test'").groupBy("isFraud").count().collect()}
    assert per == sa.split_quotas(sa.class_count_dict(tx), 0.2)


def test_digest_rank_is_a_permutation(spark):
    df = spark.range(5000).withColumnRenamed("id", "row_key").withColumn("g", F.col("row_key") % 3)
    r = sa.digest_rank(df, "row_key", 7, ["g"])
    agg = r.groupBy("g").agg(F.min("rank"), F.max("rank"), F.countDistinct("rank"), F.count("*")).collect()
    for row in agg:
        assert row[1] == 0 and row[2] == row[4] - 1 and row[3] == row[4]


def test_undersample_ratio(spark):
    tx = src.load_tx(spark, SF_CHECK)
    out = sa.undersample(tx)
    c = sa.class_count_dict(out)
    assert c[1] == 191 and c[0] == int(191 / 0.1)


def test_unknown_sampler():
    with pytest.raises(ValueError):
        sa.check_sampler("ADASYN")


# ---------------------------------------------------------------- metrics
def _pred(spark, rows):
    return spark.createDataFrame(rows, "label int, prediction int, score double")


def test_metric_edge_cases(spark):
    p = _pred(spark, [(0, 0, 0.1), (1, 0, 0.2), (0, 0, 0.3)])
    row = me.report_row(p, pos_label=1).first()
    assert row["precision"] == 0.0 and row["recall"] == 0.0 and row["f1"] == 0.0
    one = _pred(spark, [(0, 0, 0.1), (0, 0, 0.2)])
    assert me.roc_auc(one).first()["roc_auc"] is None
    tied = _pred(spark, [(0, 0, 0.5), (1, 1, 0.5), (0, 1, 0.5), (1, 0, 0.5)])
    assert me.roc_auc(tied).first()["roc_auc"] == 0.5
    with pytest.raises(ValueError):
        me.confusion(_pred(spark, [(0, 2, 0.1)]), labels=[0, 1])


def test_auc_equals_pairwise_count(spark):
    rng = np.random.default_rng(3)
    s = rng.integers(0, 50, 400) / 10.0
    y = (rng.random(400) < 0.3).astype(int)
    p = _pred(spark, [(int(a), 0, float(b)) for a, b in zip(y, s)])
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(me.roc_auc(p, partitions=8).first()["roc_auc"] - want) < 1e-12


def test_macro_is_mean_and_f1_modes_differ(spark):
    p = _pred(spark, [(0, 0, 0.), (0, 1, 0.), (1, 1, 0.), (2, 2, 0.), (2, 0, 0.), (2, 1, 0.)])
    pc = me.per_class(me.confusion(p))
    prec = pc.toPandas().sort_values("label")["precision"].to_numpy()
    macro = me.averaged(pc, "precision", "macro").first()[0]
    assert abs(macro - prec.mean()) < 1e-12
    a = me.f1(pc, "macro", "per_class").first()[0]
    b = me.f1(pc, "macro", "of_averages").first()[0]
    assert a != b
    with pytest.raises(ValueError):
        me.averaged(pc, "precision", "samples")


# ---------------------------------------------------------------- kNN
@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "cosine"])
def test_knn_join_equals_brute_force(spark, metric):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    q = e.where("vec_id % 5 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec"))
    t = e.where("vec_id % 5 <> 0").select(F.col("vec_id").alias("tid"), F.col("embedding").alias("vec"))
    got = kn.knn_join(q, t, 4, metric, n_pivots=6).toPandas()
    pe = e.toPandas()
    X = np.stack(pe.embedding.values).astype(np.float64)
    ids = pe.vec_id.to_numpy()
    m = ids % 5 == 0
    Q, T, tid = X[m], X[~m], ids[~m]
    for i, qq in enumerate(ids[m]):
        qv = Q[i]
        d = {"euclidean": np.sqrt(((T - qv) ** 2).sum(1)), "manhattan": np.abs(T - qv).sum(1),
             "cosine": 1 - (T @ qv) / (np.sqrt((T ** 2).sum(1)) * np.sqrt(qv @ qv))}[metric]
        want = tid[np.lexsort((tid, d))][:4]
        assert list(got[got.qid == qq].sort_values("rank").tid) == list(want)


def test_knn_needs_enough_train_rows(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 0.0])], "tid bigint, vec array<double>")
    with pytest.raises(ValueError):
        kn.knn_join(df.withColumnRenamed("tid", "qid"), df, 3)
    with pytest.raises(ValueError):
        kn.knn_join(df.withColumnRenamed("tid", "qid"), df, 1, "chebyshev")


def test_cosine_zero_vector_guard(spark):
    t = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0])], "tid bigint, vec array<double>")
    q = spark.createDataFrame([(9, [1.0, 1.0])], "qid bigint, vec array<double>")
    got = {r["tid"]: r["distance"] for r in kn.knn_join(q, t, 3, "cosine").collect()}
    assert abs(got[1] - 1.0) < 1e-12 and abs(got[2] - (1 - 1 / math.sqrt(2))) < 1e-12


def test_knn_vote_tie_goes_to_smaller_label(spark):
    nn = spark.createDataFrame([(1, 1, 10, 1.0, 3), (1, 2, 11, 1.0, 2)],
                               "qid bigint, rank int, tid bigint, distance double, label int")
    assert kn.knn_predict(nn, "uniform").first()["prediction"] == 2


# ---------------------------------------------------------------- SMOTE
def test_smote_counts_and_segments(spark):
    tx = src.load_tx(spark, SF_SMALL)
    feat = fe.feature_table(tx, fe.fit_type_codes(tx))
    c = sa.class_count_dict(feat)
    out = smote(feat, ["amount", "oldbalanceDest"], truncate_ints=False)
    new = out.where("row_key < 0")
    assert new.count() == int(0.1 * c[0]) - c[1]
    assert new.where("isFraud <> 1").count() == 0
    # every synthetic point lies inside the bounding box of the minority rows
    mino = feat.where("isFraud = 1").agg(F.min("amount"), F.max("amount")).first()
    b = new.agg(F.min("amount"), F.max("amount")).first()
    assert b[0] >= mino[0] - 1e-9 and b[1] <= mino[1] + 1e-9


def test_smote_rejects_negative_target(spark):
    df = spark.createDataFrame([(i, float(i), int(i < 60)) for i in range(100)], "row_key bigint, x double, isFraud int")
    with pytest.raises(ValueError):
        smote(df, ["x"])


def test_exact_percentiles_two_level_refinement_with_ties(spark):
    # accuracy 40 on groups of 20,000 rows forces the second (grid) level
    df = spark.range(60000).select(
        F.when(F.col("id") % 10 == 0, F.lit(5.0))
         .otherwise(((F.col("id") * 7919) % 100003) / 7.0).alias("x"),
        (F.col("id") % 3).alias("g"))
    ps = [0.0, 0.01, 0.5, 0.99, 1.0]
    got = exact_percentile_wide(df, "x", ps, by=["g"], accuracy=40).orderBy("g").toPandas()
    pdf = df.toPandas()
    for g in (0, 1, 2):
        want = np.quantile(pdf[pdf.g == g].x.to_numpy(), ps)
        assert np.allclose(got.iloc[g, 1:].to_numpy(dtype=float), want, rtol=0, atol=1e-9)


def test_cosine_zero_query_with_zero_train_vectors(spark):
    t = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 2.0]),
                               (5, [3.0, 3.0])], "tid bigint, vec array<double>")
    q = spark.createDataFrame([(9, [0.0, 0.0]), (8, [1.0, 1.0])], "qid bigint, vec array<double>")
    got = kn.knn_join(q, t, 3, "cosine", n_pivots=2).orderBy("qid", "rank").collect()
    zero = [(r["tid"], r["distance"]) for r in got if r["qid"] == 9]
    assert zero == [(1, 1.0), (2, 1.0), (3, 1.0)]
    other = [r["tid"] for r in got if r["qid"] == 8]
    assert other[0] == 5 and len(other) == 3


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "cosine"])
def test_knn_of_identical_vectors_emits_few_rows(spark, metric):
    n, k = 3000, 5
    ids = spark.range(n)
    same = ids.select(F.col("id").alias("tid"), F.array(F.lit(1.0), F.lit(2.0)).alias("vec"), (F.col("id") % 3).alias("label"))
    q = ids.select(F.col("id").alias("qid"), F.array(F.lit(1.0), F.lit(2.0)).alias("vec"))
    found, classes = kn.knn_candidates(q, same, k, metric, label="label")
    assert classes.count() == 1 and found.count() == n          # one class: one row per query
    rows = kn.knn_join(q, same, k, metric, label="label").groupBy("qid").agg(
        F.sort_array(F.collect_list("tid")).alias("t"), F.max("distance").alias("d"))
    assert rows.where("t <> array(0L, 1L, 2L, 3L, 4L) or d > 1e-12").count() == 0 and rows.count() == n


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "cosine"])
def test_knn_with_duplicates_blocks_and_ties(spark, metric, monkeypatch):
    monkeypatch.setattr(kn, "BLOCK", 7)
    rng = np.random.default_rng(8)
    X = rng.integers(-2, 3, (120, 3)).astype(float) * rng.choice([1.0, 2.0], (120, 1))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "tid bigint, vec array<double>")
    got = kn.knn_join(df.withColumnRenamed("tid", "qid"), df, 4, metric, n_pivots=5, exclude_self=True).toPandas()
    norm = np.sqrt((X ** 2).sum(1))
    for i in range(len(X)):
        denom = np.where(norm * norm[i] == 0, 1e-10, norm * norm[i])
        d = {"euclidean": np.sqrt(((X - X[i]) ** 2).sum(1)), "manhattan": np.abs(X - X[i]).sum(1),
             "cosine": 1 - (X @ X[i]) / denom}[metric]
        d[i] = np.inf
        mine = got[got.qid == i].sort_values("rank")
        assert np.allclose(mine.distance, np.sort(d)[:4])
        assert np.allclose(d[mine.tid.to_numpy()], mine.distance) and mine.tid.is_unique
        if metric != "cosine":       # equal cosines differ in the last bit
            assert mine.tid.tolist() == np.lexsort((np.arange(len(X)), d))[:4].tolist()


def test_string_classes_can_vote(spark):
    nn = spark.createDataFrame([(1, 1, 10, 1.0, "b"), (1, 2, 11, 1.0, "a")],
                               "qid bigint, rank int, tid bigint, distance double, label string")
    assert kn.knn_predict(nn, "uniform").first()["prediction"] == "a"


# ---------------------------------------------------------------- edge inputs
@pytest.mark.parametrize("extra", [0.0, None])
def test_corr_of_constants_is_null_with_and_without_nulls(spark, extra):
    df = spark.createDataFrame([(0.1, 1234.56, float(i), extra if i == 3 else 1.0 * i) for i in range(100)],
                               "a double, b double, c double, d double")
    got = {(r["a"], r["b"]): r["corr"] for r in st.corr_long(df, ["a", "b", "c", "d"]).collect()}
    assert all(got[x, y] is None for x, y in got if {x, y} & {"a", "b"})
    assert got["c", "c"] == pytest.approx(1.0) and all(-1 <= v <= 1 for v in got.values() if v is not None)


def test_histogram_clips_before_it_bins(spark):
    df = spark.createDataFrame([(0.0,)] * 997 + [(50.0,)] * 3, "x double")
    got = {r["bin"]: r["n"] for r in st.histogram(df, ["x"]).collect()}
    assert got[20] == 1000 and sum(got.values()) == 1000 and len(got) == 40


def test_nan_is_missing_in_describe_and_percentiles(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    r = st.describe(df, ["x"]).first()
    assert (r["count"], r["p50"], r["p75"], r["max"]) == (2, 2.0, 2.5, 3.0)


def test_auc_products_do_not_overflow(spark):
    df = spark.createDataFrame([(0.2, 0, 900_000_000_000), (0.8, 2_000_000_000, 0)], "s double, pos long, neg long")
    b = me._below(df, 2)
    assert b.agg(F.sum("pos"), F.sum("neg")).first() == (2_000_000_000, 900_000_000_000)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    assert b.agg(F.sum(pos * (F.col("neg_below") + 0.5 * neg)) / (F.sum(pos) * F.sum(neg))).first()[0] == 1.0


def test_risk_category_without_fraud(spark):
    df = spark.createDataFrame([(0, 5.0), (0, None)], "isFraud int, amount double")
    assert [r[0] for r in df.select(fe.risk_category_expr(None)).collect()] == [0, 0]


def test_percentile_bands_that_miss_are_widened(spark):
    x = np.random.default_rng(5).normal(size=20_000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = exact_percentile_wide(df, "x", [0.25, 0.5], accuracy=100, margin=0.0).first()
    assert np.allclose(list(got), np.quantile(x, [0.25, 0.5]))


# ---------------------------------------------------------------- plans that hold at any size
def test_sampling_plans_have_one_scan_and_no_join(spark):
    big = spark.range(6_000_000, numPartitions=4).select(
        F.col("id").alias("row_key"), (F.col("id") % 50 == 0).cast("int").alias("isFraud"))
    for df in (sa.stratified_split(big), sa.plain_split(big), sa.undersample(big), sa.balanced_sample(big, 2500),
               sa.stratified_folds(big)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan and plan.count("Range (") == 1, plan


def test_three_class_confusion_reads_the_events_once(spark):
    import __spark_entry__ as E
    plan = E.queries()["confusion_3class"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan        # counted once before; only the class grid is joined


# ---------------------------------------------------------------- A21 without straight points, A22 per group
def _score_rows(spark, rows, parts=5):
    return spark.createDataFrame(rows, "model string, label int, prediction int, score double").repartition(parts)


def _roc_by_hand(rows, rule):
    """Points by a plain loop; ``rule`` says whether two steps make no corner."""
    scores = sorted({r[3] for r in rows if r[3] is not None}, reverse=True)
    steps = [(sum(r[1] == 1 for r in rows if r[3] == s), sum(r[1] != 1 for r in rows if r[3] == s)) for s in scores]
    P, N = sum(p for p, _ in steps), sum(n for _, n in steps)
    out, tp, fp = {(math.inf, 0.0, 0.0)}, 0, 0
    for i, (s, (p, n)) in enumerate(zip(scores, steps)):
        tp, fp = tp + p, fp + n
        if i in (0, len(steps) - 1) or not rule((p, n), steps[i + 1]):
            out.add((s, fp / N, tp / P))
    return out


@pytest.mark.parametrize("drop,rule", [
    ("equal_steps", lambda a, b: a == b), ("collinear", lambda a, b: a[0] * b[1] == a[1] * b[0]), (None, lambda a, b: False)])
@pytest.mark.parametrize("parts", [1, 3, 7])
def test_roc_corners_across_partition_borders(spark, drop, rule, parts):
    rng = np.random.default_rng(parts)
    rows = [("m", int(rng.random() < .5), 0, float(s)) for s in np.repeat(np.arange(60), rng.integers(1, 4, 60))]
    rows += [("m", y, 0, float(s)) for s in range(100, 130) for y in (0, 1, 1)]        # a long straight stretch
    got = me.roc_points(_score_rows(spark, rows), partitions=parts, drop=drop).collect()
    assert {(r.threshold, r.fpr, r.tpr) for r in got} == _roc_by_hand(rows, rule)


def test_roc_drop_is_checked_and_empty_is_empty(spark):
    rows = _score_rows(spark, [("m", 1, 1, 0.5)])
    with pytest.raises(ValueError):
        me.roc_points(rows, drop="some")
    assert me.roc_points(rows.limit(0), drop="collinear").count() == 0
    assert me.roc_points(rows, drop="collinear").count() == 2


def test_report_rows_equal_single_reports(spark):
    rng = np.random.default_rng(8)
    rows = [(m, int(rng.random() < .3), int(rng.random() < .4), float(rng.integers(0, 9))) for m in ("a", "b", None)
            for _ in range(200)]
    rows += [("one class", 0, 0, 1.0)] * 3 + [("no score", 1, 1, None), ("no score", 0, 1, None)]
    df = _score_rows(spark, rows)
    got = {r["model"]: r for r in me.report_rows(df, "model", partitions=4).collect()}
    assert set(got) == {"a", "b", None, "one class", "no score"}
    for m in ("a", "b", None):
        one = me.report_row(df.where(F.col("model").eqNullSafe(F.lit(m))), pos_label=1).first()
        assert all(math.isclose(one[c], got[m][c], abs_tol=1e-12) for c in ("accuracy", "precision", "recall", "f1", "roc_auc"))
    assert got["one class"].roc_auc is None and got["one class"].accuracy == 1.0 and got["one class"].f1 == 0.0
    assert got["no score"].roc_auc is None and got["no score"].precision == 0.5 and got["no score"].support == 2


def test_grouped_reports_read_the_predictions_once(spark):
    """One aggregation, whatever the number of groups; two keys at a time."""
    rows = _score_rows(spark, [(f"m{i % 4}", i % 2, i % 3 % 2, float(i % 5)) for i in range(200)])
    calls = spark.sparkContext.accumulator(0)

    def seen(it):
        for b in it:
            calls.add(b.num_rows)
            yield b

    out = me.report_rows(rows.mapInArrow(seen, rows.schema), ["model", "prediction"])
    assert out.count() == 8 and calls.value == 200
