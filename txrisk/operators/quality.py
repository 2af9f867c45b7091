"""Q1-Q5: missing values, duplicates, dedupe, null drop, preprocessing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import KEY, LABEL
from ..session import cut_lineage
from .scaling import apply_scaler, fit_scaler


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q1: NULL count of every column in one pass, as (column, n_missing)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"), F.col(c).alias("n_missing"))
        for i, c in enumerate(cols)])).alias("e")).select("e.*")


def missing_nonzero(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Only the columns that have missing values."""
    return missing_counts(df, cols).where(F.col("n_missing") > 0)


def duplicate_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q2: rows beyond the first of each group (NULL equals NULL). A hot
    duplicate group is combined map-side before the shuffle."""
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def drop_duplicates(df: DataFrame, cols: Sequence[str], key: str | None = KEY) -> DataFrame:
    """Q3: keep the first row of each group; with a key the smallest key
    survives (deterministic across partitionings)."""
    cols = list(cols)
    if key and key in df.columns:
        return df.groupBy(*cols).agg(F.min(key).alias(key)).select(key, *cols)
    return df.dropDuplicates(cols)


def drop_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q4: drop rows with any NULL in ``cols`` (all columns by default)."""
    return df.dropna(how="any", subset=list(cols) if cols else None)


def preprocess(df: DataFrame, features: Sequence[str], label: str = LABEL, key: str | None = KEY,
               dedupe: bool = True, dropna: bool = True) -> DataFrame:
    """Q5: dedupe on features and label, drop NULL rows, then scale the
    features by the mean and population deviation of what is left."""
    cols = [*features, label]
    out = drop_duplicates(df, cols, key) if dedupe else df
    out = cut_lineage(drop_null(out, cols) if dropna else out)
    return apply_scaler(out, fit_scaler(out, features))


def preprocess_summary(df: DataFrame, cols: Sequence[str], key: str | None = KEY) -> DataFrame:
    """Q5: row counts in, removed as duplicates, removed for NULLs, out — one
    grouped pass over the input (duplicate groups counted, not materialised)."""
    cols = list(cols)
    anynull = F.lit(False)
    for c in cols:
        anynull = anynull | F.col(c).isNull()
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(
        F.sum("_c").cast("bigint").alias("rows_in"),
        F.sum(F.col("_c") - 1).cast("bigint").alias("duplicates_removed"),
        F.count(F.when(anynull, 1)).alias("null_rows_removed"),
        F.count(F.when(~anynull, 1)).alias("rows_out"))
