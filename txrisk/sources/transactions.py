"""Sources: the transaction scan (CSV / parquet), the adapters that derive a
transaction table from the driver's ``events`` table, literal rows, shape,
preview and the data dictionary."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import KEY, SOURCE_COLUMNS, SOURCE_SCHEMA


def load_transactions(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Scan with a fixed schema (no inference). CSV fails fast on bad rows.

    A missing path raises ``AnalysisException`` [PATH_NOT_FOUND] at load (S3).
    """
    reader = spark.read.schema(SOURCE_SCHEMA)
    if fmt == "csv":
        return reader.option("header", True).option("mode", "FAILFAST").csv(path)
    if fmt == "parquet":
        return reader.parquet(path)
    raise ValueError(f"unknown format {fmt!r}; use 'csv' or 'parquet'")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# ---- fixed values: events -> transaction mapping -----------------------------
EVENT_TO_TYPE = [("click", "CASH_IN"), ("purchase", "CASH_OUT"), ("signup", "DEBIT"),
                 ("view", "PAYMENT"), ("error", "TRANSFER")]
STEP_ORIGIN = "2024-01-01 00:00:00"
# -------------------------------------------------------------------------------


def _type_of(event_type: Column) -> Column:
    out = None
    for ev, ty in EVENT_TO_TYPE:
        out = (F.when(event_type == ev, F.lit(ty)) if out is None
               else out.when(event_type == ev, F.lit(ty)))
    return out


def tx_from_events(events: DataFrame) -> DataFrame:
    """Transaction view over ``events`` (a pure projection: streams too)."""
    eid, val, et = F.col("event_id"), F.col("value"), F.col("event_type")
    emptied = et.isin("purchase", "error") & (eid % 4 == 0)   # many such rows are no fraud
    is_fraud = F.when(emptied & (eid % 3 != 0) & (val > 60), 1).otherwise(0)
    old_org = F.when(eid % 4 == 0, val).otherwise(((eid * 37) % 1000).cast("double"))
    old_dest = ((eid * 53) % 2000).cast("double")
    step = F.expr(f"timestampdiff(HOUR, timestamp_ntz'{STEP_ORIGIN}', ts)") + 1
    base = events.select(
        eid.alias(KEY),
        step.cast("bigint").alias("step"),
        _type_of(et).alias("type"),
        val.alias("amount"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("nameOrig"),
        old_org.alias("oldbalanceOrg"),
        F.concat(F.when(et.isin("view", "signup"), F.lit("M")).otherwise(F.lit("C")),
                 ((F.col("user_id") * 7 + eid) % 150).cast("string")).alias("nameDest"),
        old_dest.alias("oldbalanceDest"),
        is_fraud.cast("int").alias("isFraud"),
        F.coalesce(emptied, F.lit(False)).alias("emptied"),
    )
    return base.select(
        KEY, "step", "type", "amount", "nameOrig", "oldbalanceOrg",
        F.greatest(F.col("oldbalanceOrg") - F.col("amount"), F.lit(0.0)).alias("newbalanceOrig"),
        "nameDest", "oldbalanceDest",
        F.when(F.col("emptied"), F.col("oldbalanceDest"))
         .otherwise(F.col("oldbalanceDest") + F.col("amount")).alias("newbalanceDest"),
        "isFraud",
        F.when((F.col("isFraud") == 1) & (F.col("amount") > 200), 1).otherwise(0)
         .cast("int").alias("isFlaggedFraud"),
    )


def load_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx_from_events(table(spark, sf_dir, "events"))


def tx_dirty_from_events(events: DataFrame) -> DataFrame:
    """``tx`` with some NULLs plus exact copies and id-only variants."""
    tx = tx_from_events(events)
    k = F.col(KEY)
    cols = [c for c in tx.columns]
    dirty = tx.select(*[
        F.when(k % 89 == 0, F.lit(None).cast("string")).otherwise(F.col("type")).alias("type")
        if c == "type" else
        F.when(k % 97 == 0, F.lit(None).cast("double")).otherwise(F.col("amount")).alias("amount")
        if c == "amount" else F.col(c)
        for c in cols])
    # Keys of the added rows are negative, so they stay unique at any size.
    copies = dirty.filter(k % 50 == 0).withColumn(KEY, -(k * 2 + 1))
    variants = (dirty.filter(k % 60 == 0).withColumn(KEY, -(k * 2 + 2))
                .withColumn("nameOrig", F.concat(F.lit("X"), F.col("nameOrig"))))
    return dirty.unionByName(copies).unionByName(variants)


def load_tx_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx_dirty_from_events(table(spark, sf_dir, "events"))


# ---- fixed values: the four literal transactions to score --------------------
# (description, step, type, amount, oldbalanceOrg, newbalanceOrig,
#  oldbalanceDest, newbalanceDest, type_encoded as printed in the source rows)
NEW_TRANSACTIONS = [
    ("TRANSFER 5,000 - account emptied", 1, "TRANSFER", 5000.0, 5000.0, 0.0, 100000.0, 105000.0, 4),
    ("CASH_OUT 850,000 - account emptied", 200, "CASH_OUT", 850000.0, 850000.0, 0.0, 0.0, 850000.0, 1),
    ("TRANSFER 18,000 - account emptied", 350, "TRANSFER", 18000.0, 18000.0, 0.0, 50000.0, 68000.0, 4),
    ("PAYMENT 200 - ordinary purchase", 10, "PAYMENT", 200.0, 5000.0, 4800.0, 1000.0, 1200.0, 2),
]
# -------------------------------------------------------------------------------


def new_transactions(spark: SparkSession) -> DataFrame:
    """The literal rows, carried by their type *string* (see T2)."""
    schema = T.StructType([
        T.StructField("tx_id", T.IntegerType(), False),
        T.StructField("description", T.StringType(), False),
        T.StructField("step", T.LongType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("oldbalanceOrg", T.DoubleType(), False),
        T.StructField("newbalanceOrig", T.DoubleType(), False),
        T.StructField("oldbalanceDest", T.DoubleType(), False),
        T.StructField("newbalanceDest", T.DoubleType(), False),
        T.StructField("literal_type_code", T.IntegerType(), False),
    ])
    rows = [(i + 1, *r) for i, r in enumerate(NEW_TRANSACTIONS)]
    return spark.createDataFrame(rows, schema)


def shape(df: DataFrame) -> DataFrame:
    """One-row (rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"))


def preview(df: DataFrame, n: int = 5, key: str = KEY) -> DataFrame:
    """Deterministic head(n) — top-n by key (partial top-k, no full sort)."""
    return df.orderBy(key).limit(n)


def data_dictionary(spark: SparkSession) -> DataFrame:
    """Column -> description, type (also stored as field metadata)."""
    return spark.createDataFrame(
        [(n, d, t.simpleString()) for n, d, t in SOURCE_COLUMNS],
        "column string, description string, spark_type string")
