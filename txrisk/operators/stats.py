"""Profiling aggregations. Every one is a single partial
(map-side combined) aggregation or a band-limited exact percentile; tiny
aggregated tables are finished with windows that never see the fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import present, safe_div
from ..functions.quantile import exact_percentiles
from ..schema import BINARY_FEATURES, LABEL


def long_form(df: DataFrame, cols: Sequence[str], name: str = "feature",
              value: str = "x") -> DataFrame:
    """Unpivot numeric columns to (feature, x) doubles (a narrow projection);
    NaN is missing."""
    return df.select(*[present(c).alias(c) for c in cols]).unpivot(
        [], list(cols), name, value)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A1: count (non-null), mean, sample std, min, 25/50/75 %, max per column."""
    long = long_form(df, cols)
    q = exact_percentiles(
        long, "x", [0.25, 0.5, 0.75], by=["feature"],
        extra_aggs=[F.count("x").alias("count"), F.avg("x").alias("mean"),
                    F.stddev_samp("x").alias("std"), F.min("x").alias("min"),
                    F.max("x").alias("max")])
    pct = F.max
    return q.groupBy("feature", "count", "mean", "std", "min", "max").agg(
        pct(F.when(F.col("i") == 0, F.col("value"))).alias("p25"),
        pct(F.when(F.col("i") == 1, F.col("value"))).alias("p50"),
        pct(F.when(F.col("i") == 2, F.col("value"))).alias("p75"),
    ).select("feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def _corr_stack(wide: DataFrame, cols: list[str], pairs) -> DataFrame:
    items = []
    for i, j in pairs:
        items.append(f"'{cols[i]}', '{cols[j]}', c{i}_{j}")
        if i != j:
            items.append(f"'{cols[j]}', '{cols[i]}', c{i}_{j}")
    return wide.selectExpr(f"stack({len(items)}, {', '.join(items)}) AS (a, b, corr)")


def corr_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A2: Pearson correlation of every pair over rows where both are present;
    a constant column (min = max) gives NULL, not an ANSI divide-by-zero or a
    quotient of rounding errors (T10); values are clamped to [-1, 1]. Long form
    (a, b, corr), full square.

    Pass 1 (one row to the driver): counts, means, smallest and largest values.
    Without NULLs, pass 2 is the classic two-pass centred form — one sum per
    pair — which stays inside whole-stage codegen. With NULLs, every pair
    gets its own pairwise-complete covariance and deviations.
    Expressions are built as SQL strings: hundreds of Column objects through
    the Python bridge cost seconds of driver time."""
    cols = list(cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    df = df.select(*[present(c).alias(c) for c in cols])
    q = lambda c: f"`{c}`"
    clamp = lambda e: f"greatest(-1D, least(1D, {e}))"
    first = df.agg(F.count(F.lit(1)).alias("_n"),
                   *[f(c).alias(f"{tag}{i}") for i, c in enumerate(cols)
                     for tag, f in (("n", F.count), ("m", F.avg), ("lo", F.min), ("hi", F.max))]).first()
    if all(first[f"n{i}"] == first["_n"] for i in range(len(cols))):
        cen = [f"({q(c)} - CAST({first[f'm{i}']!r} AS DOUBLE))" if first[f"m{i}"] is not None else "NULL"
               for i, c in enumerate(cols)]
        sums = df.agg(*[F.expr(f"sum({cen[i]} * {cen[j]}) AS s{i}_{j}") for i, j in pairs])
        varies = [first[f"lo{i}"] is not None and first[f"lo{i}"] < first[f"hi{i}"] for i in range(len(cols))]
        wide = sums.select(*[
            F.expr(clamp(f"try_divide(s{i}_{j}, sqrt(s{i}_{i}) * sqrt(s{j}_{j}))")
                   if varies[i] and varies[j] else "CAST(NULL AS DOUBLE)").alias(f"c{i}_{j}") for i, j in pairs])
        return _corr_stack(wide, cols, pairs)
    exprs = []
    for i, j in pairs:
        a, b = q(cols[i]), q(cols[j])
        both = f"(`{cols[i]}` IS NOT NULL AND `{cols[j]}` IS NOT NULL)"
        xa, xb = f"IF({both}, {a}, NULL)", f"IF({both}, {b}, NULL)"
        varies = f"min({xa}) < max({xa}) AND min({xb}) < max({xb})"
        value = f"try_divide(covar_samp({xa}, {xb}), stddev_samp({xa}) * stddev_samp({xb}))"
        exprs.append(f"IF({varies}, {clamp(value)}, NULL) AS c{i}_{j}")
    return _corr_stack(df.agg(*[F.expr(e) for e in exprs]), cols, pairs)


def class_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    """A3: rows per class, NULL class dropped, sorted by class."""
    return (df.where(F.col(label).isNotNull()).groupBy(label)
            .agg(F.count(F.lit(1)).alias("count")).orderBy(label))


def class_shares(df: DataFrame, label: str = LABEL) -> DataFrame:
    """A4: count and percentage per class (window over the tiny result only)."""
    c = class_counts(df, label)
    return c.select(label, "count",
                    (F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy())).alias("pct"))


def imbalance(df: DataFrame, label: str = LABEL) -> DataFrame:
    """A5: n0, n1 and the floor ratio n0 // n1."""
    agg = df.agg(F.count(F.when(F.col(label) == 0, 1)).alias("n0"),
                 F.count(F.when(F.col(label) == 1, 1)).alias("n1"))
    return agg.select("n0", "n1", F.floor(F.try_divide(F.col("n0"), F.col("n1"))).alias("ratio"))


def fraud_by_type(df: DataFrame, type_col: str = "type", label: str = LABEL) -> DataFrame:
    """Per type: frauds, total, fraud share in % (half-even to 3 places)."""
    return (df.where(F.col(type_col).isNotNull()).groupBy(type_col)
            .agg(F.sum(label).cast("bigint").alias("fraud"),
                 F.count(label).alias("total"),
                 F.bround(F.avg(label) * 100, 3).alias("pct")))


def fraud_rate(df: DataFrame, type_col: str = "type", label: str = LABEL) -> DataFrame:
    """Fraud rate in % per type (column-pruned to two columns at the scan)."""
    return (df.select(type_col, label).where(F.col(type_col).isNotNull())
            .groupBy(type_col).agg((F.avg(label) * 100).alias("fraud_rate")))


def percentile_of(df: DataFrame, col: str, p: float, name: str = "value") -> DataFrame:
    """One exact percentile as a one-row table."""
    return exact_percentiles(df, col, [p]).select(F.col("value").alias(name))


def split_summary(df: DataFrame, split: str = "split", label: str = LABEL) -> DataFrame:
    """A10: rows, frauds and fraud % per split (or per resampling stage)."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(label).cast("bigint").alias("fraud"),
        (F.avg(label) * 100).alias("fraud_pct"))


def risk_counts(df: DataFrame, risk: str = "risk_category", n_classes: int = 3) -> DataFrame:
    """Count and % for every risk class 0..n-1, zero kept."""
    counts = df.groupBy(risk).agg(F.count(F.lit(1)).alias("count"))
    dense = (counts.select(F.map_from_entries(F.collect_list(F.struct(risk, "count"))).alias("m"),
                           F.sum("count").alias("total")))
    return (dense.select(F.explode(F.sequence(F.lit(0), F.lit(n_classes - 1))).alias(risk), "m", "total")
            .select(F.col(risk).cast("int").alias(risk),
                    F.coalesce(F.try_element_at("m", F.col(risk)), F.lit(0)).cast("bigint").alias("count"),
                    "total")
            .select(risk, "count", safe_div(F.col("count") * 100.0, F.col("total")).alias("pct")))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 40, cap_p: float = 0.99) -> DataFrame:
    """Per column, clip at its own exact p99 (upper only), then ``bins``
    equal-width bins over [min, cap]; last bin closed; min == cap -> +-0.5.
    Dense output (feature, bin, lo, hi, n). The parameters (one row per column)
    are literals of the counting pass: no join, no key per column."""
    cols = list(cols)
    found = exact_percentiles(long_form(df, cols), "x", [cap_p], by=["feature"], extra_aggs=[F.min("x").alias("mn")])
    params = {r["feature"]: (r["mn"], r["value"]) for r in found.collect() if r["value"] is not None}
    spark = df.sparkSession
    edges = {c: (lo - 0.5, cap + 0.5) if lo == cap else (lo, cap) for c, (lo, cap) in params.items()}

    def bin_of(c: str):
        (lo, hi), cap = edges[c], params[c][1]
        x = F.least(present(c), F.lit(cap))
        b = F.least(F.floor((x - F.lit(lo)) * bins / F.lit(hi - lo)), F.lit(bins - 1)).cast("int")
        return F.struct(F.lit(c).alias("feature"), F.when(present(c).isNotNull(), b).alias("bin"))
    grid = spark.createDataFrame(
        [(c, b, lo + b * ((hi - lo) / bins), lo + (b + 1) * ((hi - lo) / bins))
         for c, (lo, hi) in edges.items() for b in range(bins)],
        "feature string, bin int, bin_lo double, bin_hi double")
    if not edges:
        return grid.withColumn("n", F.lit(0).cast("bigint"))
    counts = (df.select(F.explode(F.array(*[bin_of(c) for c in edges])).alias("b")).select("b.*")
              .where(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n")))
    return (grid.join(counts, ["feature", "bin"], "left")
            .select("feature", "bin", "bin_lo", "bin_hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def histogram_columns(cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c not in BINARY_FEATURES]


def classes(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Distinct classes, sorted."""
    return df.select(label).where(F.col(label).isNotNull()).distinct().orderBy(label)


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """A25: 'balanced' weights n / (k * n_c) (T16), from the tiny count table."""
    c = class_counts(df, label)
    whole = Window.partitionBy()
    return c.select(label, "count",
                    (F.sum("count").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("count"))).alias("weight"))


def pos_weight(df: DataFrame, label: str = LABEL) -> DataFrame:
    """n0 / n1 (the boosting scale_pos_weight)."""
    return imbalance(df, label).select("n0", "n1", F.try_divide(F.col("n0"), F.col("n1")).alias("pos_weight"))


def with_weights(df: DataFrame, label: str = LABEL, out: str = "weight") -> DataFrame:
    """Attach the balanced class weight by position in one literal list of the
    classes (no join: a class may hold most rows). NULL classes get no weight."""
    rows = class_weights(df, label).collect()
    if not rows:
        return df.withColumn(out, F.lit(None).cast("double"))
    at = F.array_position(F.lit([r[label] for r in rows]), F.col(label))
    return df.withColumn(out, F.try_element_at(F.lit([float(r["weight"]) for r in rows]), F.nullif(at, F.lit(0)).cast("int")))
