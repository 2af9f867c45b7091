"""Exact-count splits and samples in a partition-independent order.

Membership follows the order ``(md5(key:seed), key)`` inside each class, so
the same rows are chosen under any partitioning (T12). "The first q rows of a
class" is a comparison with one literal, the (digest, key) at rank q:

1. a histogram over the first 20 digest bits (partial aggregation) gives the
   class totals and the bucket that holds rank q;
2. a second pass ranks only that bucket (about n / 2^20 rows) and returns the
   (digest, key) at rank q, one row per class and quota;
3. the result is a projection of the input: one scan, no join, no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import digest
from ..schema import KEY, LABEL
from ..session import cut_lineage

BUCKET_HEX = 5            # 20 bits -> up to 1,048,576 buckets per class
_ALL, _NONE = "g", ""     # above and below every hex digest


def _bucket(d: Column) -> Column:
    return F.conv(F.substring(d, 1, BUCKET_HEX), 16, 10).cast("bigint")


def _digested(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.withColumn("_d", digest(key, seed)).withColumn("_bk", _bucket(F.col("_d")))


def _by_class(by: Column, values: dict, otherwise: Column) -> Column:
    """CASE over the classes (the class list is the model's, not the data's)."""
    out = None
    for c, v in values.items():
        hit = by == F.lit(c)
        out = F.when(hit, v) if out is None else out.when(hit, v)
    return otherwise if out is None else out.otherwise(otherwise)


def bucket_histogram(df: DataFrame, key: str = KEY, seed: int = 42, by: str | None = None) -> DataFrame:
    """(class, bucket, rows, offset), at most classes x 2^20 rows, written once
    so that class totals and offsets come from one pass over the data."""
    group = F.col(by) if by else F.lit(0)
    hist = _digested(df.select(group.alias("_c"), key), key, seed).groupBy("_c", "_bk") \
        .agg(F.count(F.lit(1)).alias("_bn"))
    before = Window.partitionBy("_c").orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    return cut_lineage(hist.withColumn("_off", F.coalesce(F.sum("_bn").over(before), F.lit(0))))


def hist_class_counts(hist: DataFrame) -> dict:
    return {r["_c"]: r["n"] for r in hist.groupBy("_c").agg(F.sum("_bn").alias("n")).collect()}


def digest_cuts(df: DataFrame, hist: DataFrame, quotas: dict, key: str, seed: int,
                by: str | None = None) -> dict:
    """Per class and quota the (digest, key) at that rank: rows before it are
    the first ``quota`` rows. One row per class and quota reaches the driver."""
    counts = hist_class_counts(hist)
    open_ = {c: sorted({q for q in qs if 0 < q < counts.get(c, 0)}) for c, qs in quotas.items()}
    found: dict = {}
    if any(open_.values()):
        kind = hist.schema["_c"].dataType.simpleString()
        wanted = df.sparkSession.createDataFrame([(c, q) for c, qs in open_.items() for q in qs],
                                                 f"_c {kind}, _q bigint")
        edge = hist.join(wanted, "_c").where((F.col("_off") <= F.col("_q")) & (F.col("_q") < F.col("_off") + F.col("_bn")))
        edges: dict = {}
        for r in edge.select("_c", "_bk", "_q", "_off").collect():
            edges.setdefault(r["_c"], {}).setdefault(r["_bk"], []).append((r["_q"], r["_q"] - r["_off"] + 1))
        group = F.col(by) if by else F.lit(0)
        rows = _digested(df.select(group.alias("_c"), F.col(key).alias("_k")), "_k", seed)
        hit = _by_class(F.col("_c"), {c: F.col("_bk").isin(*b) for c, b in edges.items()}, F.lit(False))
        w = Window.partitionBy("_c", "_bk").orderBy("_d", "_k")
        nth = _by_class(F.col("_c"), {
            c: _by_class(F.col("_bk"), {b: F.col("_n").isin(*[n for _, n in qs]) for b, qs in bs.items()}, F.lit(False))
            for c, bs in edges.items()}, F.lit(False))
        ranked = rows.where(hit).withColumn("_n", F.row_number().over(w)).where(nth)
        for r in ranked.select("_c", "_bk", "_n", "_d", "_k").collect():
            for q, n in edges[r["_c"]][r["_bk"]]:
                if n == r["_n"]:
                    found[r["_c"], q] = (r["_d"], r["_k"])
    return {c: [found.get((c, q), (_NONE if q <= 0 else _ALL, None)) for q in qs] for c, qs in quotas.items()}


def before_cut(cuts: dict, i: int, key: str = KEY, seed: int = 42, by: str | None = None) -> Column:
    """Whether a row comes before the i-th cut of its class."""
    d = digest(key, seed)

    def test(cut):
        at, k = cut
        return d < F.lit(at) if k is None else (d < F.lit(at)) | ((d == F.lit(at)) & (F.col(key) < F.lit(k)))
    if by is None:
        return test(cuts[0][i])
    return _by_class(F.col(by), {c: test(v[i]) for c, v in cuts.items()}, F.lit(False))


def digest_rank(df: DataFrame, key: str = KEY, seed: int = 42, by: Sequence[str] = (),
                out: str = "rank") -> DataFrame:
    """Exact 0-based rank within ``by`` ordered by (digest, key). Joins the
    bucket offsets, so it is for small frames (SMOTE's minority class)."""
    by = list(by)
    d = _digested(df, key, seed)
    hist = d.groupBy(*by, "_bk").agg(F.count(F.lit(1)).alias("_bn"))
    before = Window.partitionBy(*by).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn("_off", F.coalesce(F.sum("_bn").over(before), F.lit(0)))
    w = Window.partitionBy(*by, "_bk").orderBy("_d", key)
    return (d.join(hist, [*by, "_bk"]).withColumn(out, F.col("_off") + F.row_number().over(w) - 1)
             .drop("_d", "_bk", "_bn", "_off"))


# ------------------------------------------------------------------ quotas
def class_count_dict(df: DataFrame, label: str = LABEL) -> dict:
    rows = df.where(F.col(label).isNotNull()).groupBy(label).count().collect()
    return {r[label]: r["count"] for r in rows}


def largest_remainder(counts: dict, n_draws: int) -> dict:
    """Spread ``n_draws`` over classes in proportion to ``counts``: floors,
    then one more for the largest remainders (ties: smaller class first)."""
    n = sum(counts.values())
    if n == 0:
        return {c: 0 for c in counts}
    fl = {c: (n_draws * k) // n for c, k in counts.items()}
    rem = {c: (n_draws * k) % n for c, k in counts.items()}
    need = n_draws - sum(fl.values())
    for c in sorted(counts, key=lambda c: (-rem[c], c))[:need]:
        fl[c] += 1
    return fl


def split_quotas(counts: dict, test_size: float = 0.2) -> dict:
    """Per class test rows: n_test = ceil(test_size * n); train quotas by
    largest remainder, test gets the rest of each class."""
    n = sum(counts.values())
    n_test = math.ceil(test_size * n)
    train = largest_remainder(counts, n - n_test)
    return {c: counts[c] - train[c] for c in counts}


def _train_test(first: Column) -> Column:
    return F.when(first, "test").otherwise("train")


def stratified_split(df: DataFrame, label: str = LABEL, test_size: float = 0.2,
                     seed: int = 42, key: str = KEY, out: str = "split") -> DataFrame:
    """``split`` column 'train'/'test' with exact per-class counts."""
    src = df.where(F.col(label).isNotNull())
    hist = bucket_histogram(src, key, seed, label)
    quotas = {c: [q] for c, q in split_quotas(hist_class_counts(hist), test_size).items()}
    cuts = digest_cuts(src, hist, quotas, key, seed, label)
    return src.withColumn(out, _train_test(before_cut(cuts, 0, key, seed, label)))


def plain_split(df: DataFrame, test_size: float = 0.2, seed: int = 42, key: str = KEY,
                out: str = "split") -> DataFrame:
    """R2: unstratified split, n_test = ceil(test_size * n)."""
    hist = bucket_histogram(df, key, seed)
    n = sum(hist_class_counts(hist).values())
    cuts = digest_cuts(df, hist, {0: [math.ceil(test_size * n)]}, key, seed)
    return df.withColumn(out, _train_test(before_cut(cuts, 0, key, seed)))


def _first_rows(src: DataFrame, quota_of, label: str, key: str, seed: int) -> DataFrame:
    """The first ``quota_of(class counts)[class]`` rows of every class."""
    hist = bucket_histogram(src, key, seed, label)
    quotas = {c: [q] for c, q in quota_of(hist_class_counts(hist)).items()}
    cuts = digest_cuts(src, hist, quotas, key, seed, label)
    return src.where(before_cut(cuts, 0, key, seed, label))


def undersample(df: DataFrame, label: str = LABEL, ratio: float = 0.1, seed: int = 42,
                key: str = KEY) -> DataFrame:
    """R4 (T15): keep every minority row and int(n_minor / ratio) majority
    rows, without replacement."""
    def quota(counts):
        if len(counts) != 2:
            raise ValueError("undersampling needs exactly two classes")
        minor, major = sorted(counts, key=lambda c: (counts[c], c))
        return {minor: counts[minor], major: min(int(counts[minor] / ratio), counts[major])}
    return _first_rows(df.where(F.col(label).isNotNull()), quota, label, key, seed)


def balanced_sample(df: DataFrame, n_each: int, label: str = LABEL, seed: int = 42,
                    key: str = KEY) -> DataFrame:
    """min(n_each, class size) rows of every class."""
    return _first_rows(df.where(F.col(label).isNotNull()), lambda counts: dict.fromkeys(counts, n_each),
                       label, key, seed)


def unshuffled_fold_bounds(counts: dict, n_splits: int = 3) -> dict:
    """Per class fold sizes of unshuffled stratified k-fold: classes laid out
    one after another, positions dealt round-robin to folds."""
    out, start = {}, 0
    for c in sorted(counts):
        n_c = counts[c]
        sizes = []
        for i in range(n_splits):
            def upto(x, i=i):
                return 0 if x <= i else (x - i - 1) // n_splits + 1
            sizes.append(upto(start + n_c) - upto(start))
        bounds, acc = [], 0
        for s in sizes[:-1]:
            acc += s
            bounds.append(acc)
        out[c] = bounds
        start += n_c
    return out


def stratified_folds(df: DataFrame, n_splits: int = 3, label: str = LABEL, seed: int = 42,
                     key: str = KEY, out: str = "fold") -> DataFrame:
    """Fold index 0..n_splits-1 per row, exact per-class fold sizes."""
    src = df.where(F.col(label).isNotNull())
    hist = bucket_histogram(src, key, seed, label)
    bounds = unshuffled_fold_bounds(hist_class_counts(hist), n_splits)
    cuts = digest_cuts(src, hist, bounds, key, seed, label)
    fold = F.lit(n_splits - 1)
    for i in reversed(range(n_splits - 1)):
        fold = F.when(before_cut(cuts, i, key, seed, label), F.lit(i)).otherwise(fold)
    return src.withColumn(out, fold.cast("int"))


SAMPLERS = ("SMOTE", "undersampling")


def check_sampler(name: str) -> str:
    """Only the two samplers exist."""
    if name not in SAMPLERS:
        raise ValueError(f"unknown sampler {name!r}: choose one of {', '.join(SAMPLERS)}")
    return name
