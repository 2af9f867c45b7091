"""Standard scaling with the population std; zero std divides by 1.

``fit_scaler`` is one partial aggregation returning 2 numbers per column to
the driver; ``apply_scaler`` embeds them as literals (no join, no broadcast).
Fit on train only (script) or on everything (manager, leaks) — caller picks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ScalerStats = dict[str, tuple[float, float]]


def scaler_stats_frame(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_pop(x).alias(f"{c}__std")]
    return df.agg(*aggs)


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> ScalerStats:
    row = scaler_stats_frame(df, cols).first()
    return {c: (row[f"{c}__mean"], row[f"{c}__std"]) for c in cols}


def scale_expr(c: str, mean: float | None, std: float | None):
    if mean is None:
        return F.lit(None).cast("double")
    div = 1.0 if (std is None or std == 0.0) else float(std)
    return (F.col(c).cast("double") - F.lit(float(mean))) / F.lit(div)


def apply_scaler(df: DataFrame, stats: ScalerStats) -> DataFrame:
    return df.withColumns({c: scale_expr(c, m, s) for c, (m, s) in stats.items()})
