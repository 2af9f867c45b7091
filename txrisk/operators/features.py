"""Label encoding and the six derived features, risk category, maps.

All functions are projections (no shuffle, no global window), so they run
unchanged on streaming DataFrames once the type mapping is fitted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import clip_upper, flag
from ..schema import (DROPPED_COLUMNS, FEATURE_COLS, KEY, LABEL, SUSPICIOUS_TYPES)

def fit_type_codes(df: DataFrame, col: str = "type") -> list[str]:
    """Fit an alphabetical 0-based label encoding.

    The distinct values are aggregated on the executors; the category list
    reaches the driver (like ``StringIndexer``).
    """
    distinct = df.select(col).where(F.col(col).isNotNull()).distinct()
    return [r[0] for r in distinct.orderBy(col).collect()]


def type_code_table(df: DataFrame, cats: list[str], col: str = "type") -> DataFrame:
    """Code -> category, as a table derived from ``df``'s distinct values."""
    return apply_type_codes(
        df.select(col).where(F.col(col).isNotNull()).distinct(), cats, col, "code"
    ).select(F.col(col), F.col("code"))


def encode_expr(c: Column, cats: list[str]) -> Column:
    """Category -> code via a literal map; NULL or unseen -> len(cats) (T5:
    ``handleInvalid='keep'``)."""
    if not cats:
        return F.lit(0)
    at = F.array_position(F.lit(list(cats)), c)      # one literal however many categories
    return F.when(at > 0, at - 1).otherwise(F.lit(len(cats))).cast("int")


def apply_type_codes(df: DataFrame, cats: list[str], col: str = "type",
                     out: str = "type_encoded") -> DataFrame:
    return df.withColumn(out, encode_expr(F.col(col), cats))


def derived_columns() -> dict[str, Column]:
    """P2-P6 (T3: unknown comparisons count as False)."""
    bdo = F.col("newbalanceOrig") - F.col("oldbalanceOrg")
    return {
        "balance_diff_orig": bdo,
        "balance_diff_dest": F.col("newbalanceDest") - F.col("oldbalanceDest"),
        "orig_zeroed": flag((F.col("oldbalanceOrg") > 0) & (F.col("newbalanceOrig") == 0)),
        "suspicious_type": flag(F.col("type").isin(*SUSPICIOUS_TYPES)),
        "amount_balance_error": F.abs(F.col("amount") + bdo),
    }


def engineer_features(df: DataFrame, cats: list[str], drop: bool = True) -> DataFrame:
    """Encode ``type``, add the five derived features, drop id columns."""
    out = apply_type_codes(df, cats).withColumns(derived_columns())
    return out.drop(*DROPPED_COLUMNS) if drop else out


def feature_table(df: DataFrame, cats: list[str], order: list[str] = FEATURE_COLS,
                  key: str = KEY, label: str = LABEL, extra: tuple[str, ...] = ()) -> DataFrame:
    """Key, the features in a fixed order, label, carried columns."""
    eng = engineer_features(df, cats, drop=False)
    keep = ([key] if key in eng.columns else []) + list(order) + [label, *extra]
    return eng.select(*keep)


def risk_category_expr(fraud_median: float | None, label: str = LABEL, amount: str = "amount") -> Column:
    """P14 (T27): 0 normal; fraud at or below the median -> 1; else 2. Without
    any fraud row there is no median (None) and every row is normal."""
    if fraud_median is None:
        return F.lit(0).cast("int")
    return (F.when(F.coalesce(F.col(label) == 0, F.lit(False)), 0)
             .when(F.coalesce(F.col(amount) <= F.lit(float(fraud_median)), F.lit(False)), 1)
             .otherwise(2).cast("int"))


def code_to_name(c: Column, names: dict[int, str]) -> Column:
    """Code -> text through a literal map."""
    m = F.create_map(*[x for k, v in sorted(names.items()) for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, c)


def clip_columns(df: DataFrame, caps: dict[str, float]) -> DataFrame:
    """Clip each column at its cap, keeping NULLs."""
    return df.withColumns({c: clip_upper(c, float(v)) for c, v in caps.items()})
