"""Exact percentiles (linear interpolation) without gathering a group.

Spark's exact ``percentile`` aggregate keeps every distinct value of a group
in one buffer, which does not survive a 100 TB column. Instead, with a
moderate Greenwald-Khanna accuracy ``acc`` (rank error <= n / acc):

A. one pass: per group ``count`` and ``percentile_approx`` at
   ``p +- margin / acc`` — a value band per percentile that provably holds
   the order statistics at floor(h) and ceil(h), h = (n - 1) p (the margin
   also covers the one-rank gap between ceil(p n) and h). A group of fewer
   than 2 * acc rows simply takes its whole range (bounded).
B. only if some band still holds more than 2 * acc rows: a pass over the
   band rows refines it with a second ``percentile_approx`` on a fixed grid
   of fractions (grid step 4 / acc of the band, two steps of margin), while
   rows below the band are counted — a band of about 160 n / acc^2 rows.
C. a last pass: rows below the band collapse map-side into one counter per
   (group, percentile), rows inside become (value, count) pairs, rows above
   are dropped; a running count over the band values locates the two ranks
   and interpolates ``lo + (hi - lo) * (h - floor h)``.

No window or buffer ever holds more than a band. Pass C checks that a band
holds both its ranks; if one does not, the search runs again in wider bands.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .exprs import present

DEFAULT_ACCURACY = 10_000
MARGIN = 4.0
GRID_MARGIN = 2


def _explode_bands(rows: DataFrame, g: list[str], m: int, lo_of, hi_of, extra: list[str]) -> DataFrame:
    """One record per (row, percentile): below / in band (value) / dropped.
    A static array of m structs (no lambda), so it stays in generated code."""
    xv = F.col("_x")

    def rec(i: int):
        lo, hi = lo_of(i), hi_of(i)
        below = xv < lo
        return F.struct(F.lit(i).alias("i"), below.alias("below"),
                        F.when(~below & (xv <= hi), xv).alias("v"))

    return (rows.select(*g, *extra, F.explode(F.array(*[rec(i) for i in range(m)])).alias("r"))
            .select(*g, *extra, "r.i", "r.below", "r.v")
            .where(F.col("below") | F.col("v").isNotNull()))


def _attach_bands(vals: DataFrame, bands: DataFrame, g: list[str], grouped: bool) -> DataFrame:
    """Give every row its group's bands. Grouped: an equi-join on the group
    keys (the band table has one row per group). Global: the single band row
    (m percentiles) is embedded as a literal — no join at all."""
    packed = bands.groupBy(*g, "_n").agg(F.sort_array(F.collect_list(F.struct("i", "_lo", "_hi"))).alias("_bb"))
    if grouped:
        return vals.join(packed, g)
    row = packed.first()
    if row is None:
        return vals.withColumn("_n", F.lit(0).cast("bigint")).withColumn(
            "_bb", F.array().cast("array<struct<i:int,_lo:double,_hi:double>>"))
    lit_bb = F.array(*[F.struct(F.lit(int(b["i"])).alias("i"), F.lit(float(b["_lo"])).alias("_lo"),
                                F.lit(float(b["_hi"])).alias("_hi")) for b in row["_bb"]])
    return vals.withColumn("_n", F.lit(int(row["_n"])).cast("bigint")).withColumn("_bb", lit_bb)


def exact_percentiles(df: DataFrame, x: str | Column, probs: Sequence[float],
                      by: Sequence[str] = (), extra_aggs: Sequence[Column] = (),
                      accuracy: int = DEFAULT_ACCURACY, margin: float = MARGIN) -> DataFrame:
    """Per group: one row per percentile ``(by..., i, p, n, value, extra...)``.

    NULLs are ignored (pandas ``quantile`` skips NaN). ``extra_aggs`` are
    computed in the first pass and carried through.
    """
    by = list(by)
    g = by or ["_g"]
    xc = F.col(x) if isinstance(x, str) else x
    keep = [x] if isinstance(x, str) and x not in by and x != "_x" else []
    base = df.select(*by, *keep, present(xc).alias("_x"))
    if not by:
        base = base.withColumn("_g", F.lit(0))
    probs = [float(p) for p in probs]
    for p in probs:
        if not 0.0 <= p <= 1.0:
            raise ValueError(f"percentile {p} outside [0, 1]")
    m = len(probs)
    big = 2 * accuracy
    fr: list[float] = []
    for p in probs:
        fr += [max(0.0, p - margin / accuracy), min(1.0, p + margin / accuracy)]

    # ---- A: counts, first bands, extra aggregates (one row per group)
    stats = (base.groupBy(*g)
             .agg(F.count("_x").alias("_n"), F.percentile_approx("_x", fr, accuracy).alias("_b"), *extra_aggs))
    extra_cols = [c for c in stats.columns if c not in set(g) | {"_n", "_b"}]
    stats = cut_lineage(stats)
    vals = base.where(F.col("_x").isNotNull()).drop(*keep)
    p_arr = F.array(*[F.lit(p) for p in probs])
    ninf, pinf = F.lit(float("-inf")), F.lit(float("inf"))

    bands = (stats.select(*g, "_n", F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("i"), "_b")
             .select(*g, "_n", "i",
                     F.when(F.col("_n") < big, ninf).otherwise(F.element_at("_b", F.col("i") * 2 + 1)).alias("_lo"),
                     F.when(F.col("_n") < big, pinf).otherwise(F.element_at("_b", F.col("i") * 2 + 2)).alias("_hi")))
    max_n = stats.agg(F.max("_n")).first()[0] or 0

    # ---- B: refine bands still wider than 2 * acc rows (only on big groups)
    if max_n >= accuracy * accuracy / 4:
        grid_n = max(8, accuracy // 4)
        grid = [j / grid_n for j in range(grid_n + 1)]
        j1 = _attach_bands(vals, bands, g, bool(by))
        lo1 = lambda i: F.col("_bb")[i]["_lo"]
        hi1 = lambda i: F.col("_bb")[i]["_hi"]
        e = _explode_bands(j1, g, m, lo1, hi1, ["_n"])
        ref = e.groupBy(*g, "_n", "i").agg(
            F.count(F.when(F.col("below"), 1)).alias("_cb"),
            F.count("v").alias("_nb"),
            F.percentile_approx("v", grid, accuracy).alias("_grid"))
        h = (F.col("_n") - 1) * F.element_at(p_arr, F.col("i") + 1)
        tlo = (F.floor(h) - F.col("_cb")) / F.col("_nb") * grid_n
        thi = (F.ceil(h) - F.col("_cb")) / F.col("_nb") * grid_n
        inside = lambda j: F.greatest(F.lit(0), F.least(F.lit(grid_n), j)).cast("int")
        jlo, jhi = inside(F.floor(tlo) - GRID_MARGIN), inside(F.ceil(thi) + GRID_MARGIN)
        refined = ref.select(*g, "i", (F.col("_nb") > big).alias("_wide"),
                             F.element_at("_grid", jlo + 1).alias("_lo2"),
                             F.element_at("_grid", jhi + 1).alias("_hi2"))
        bands = (bands.join(refined, [*g, "i"], "left")
                 .select(*g, "_n", "i",
                         F.when(F.coalesce("_wide", F.lit(False)), F.col("_lo2")).otherwise(F.col("_lo")).alias("_lo"),
                         F.when(F.coalesce("_wide", F.lit(False)), F.col("_hi2")).otherwise(F.col("_hi")).alias("_hi")))

    # ---- C: exact ranks inside the final bands
    j = _attach_bands(vals, bands, g, bool(by))
    e = _explode_bands(j, g, m, lambda i: F.col("_bb")[i]["_lo"], lambda i: F.col("_bb")[i]["_hi"], ["_n"])
    counted = cut_lineage(e.groupBy(*g, "_n", "i", "below", "v").agg(F.count(F.lit(1)).alias("_c")))
    # Both ranks must lie inside the band; on a miss, search again in wider bands.
    hh = (F.col("_n") - 1) * F.element_at(p_arr, F.col("i") + 1)
    missed = counted.groupBy(*g, "_n", "i").agg(
        F.sum(F.when(F.col("below"), F.col("_c")).otherwise(0)).alias("_under"), F.sum("_c").alias("_upto")) \
        .where((F.col("_under") > F.floor(hh)) | (F.col("_upto") <= F.ceil(hh)))
    if not missed.isEmpty():
        if margin >= accuracy:
            raise ArithmeticError("percentile bands do not hold their ranks")
        return exact_percentiles(df, x, probs, by, extra_aggs, accuracy, max(1.0, margin) * 8)
    w = (Window.partitionBy(*g, "i").orderBy(F.col("below").desc(), F.col("v").asc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    h = (F.col("_n") - 1) * F.col("p")
    ranked = (counted.withColumn("_cum", F.sum("_c").over(w))
              .withColumn("p", F.element_at(p_arr, F.col("i") + 1))
              .withColumn("_rlo", F.floor(h)).withColumn("_rhi", F.ceil(h))
              .where(~F.col("below")))
    picked = ranked.groupBy(*g, "i", "p", "_n").agg(
        F.min(F.when(F.col("_cum") > F.col("_rlo"), F.col("v"))).alias("_vlo"),
        F.min(F.when(F.col("_cum") > F.col("_rhi"), F.col("v"))).alias("_vhi"))
    frac = (F.col("_n") - 1) * F.col("p") - F.floor((F.col("_n") - 1) * F.col("p"))
    out = picked.select(*g, "i", "p", F.col("_n").alias("n"),
                        (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * frac).alias("value"))
    if extra_cols and by:
        out = out.join(stats.select(*g, *extra_cols), on=g)
    elif extra_cols:
        srow = stats.select(*extra_cols).first()
        out = out.withColumns({c: F.lit(srow[c]) if srow else F.lit(None) for c in extra_cols})
    return out.drop("_g") if not by else out


def exact_percentile_wide(df: DataFrame, x: str | Column, probs: Sequence[float],
                          by: Sequence[str] = (), names: Sequence[str] | None = None,
                          **kw) -> DataFrame:
    """Same, pivoted to one column per percentile (one row per group)."""
    names = list(names or [f"p{i}" for i in range(len(probs))])
    long = exact_percentiles(df, x, probs, by, **kw)
    aggs = [F.max(F.when(F.col("i") == i, F.col("value"))).alias(n) for i, n in enumerate(names)]
    if by:
        return long.groupBy(*by).agg(*aggs)
    return long.agg(*aggs)


def exact_percentile_value(df: DataFrame, x: str | Column, p: float, **kw) -> float | None:
    """A fitted scalar (one number to the driver)."""
    row = exact_percentile_wide(df, x, [p], names=["v"], **kw).first()
    return None if row is None else row["v"]
