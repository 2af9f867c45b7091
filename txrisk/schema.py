"""Fixed schemas and constants of the transaction data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values (must equal the reference for equal results) -------------
# Source columns with their descriptions, in file order.
SOURCE_COLUMNS = [
    ("step", "time unit, one step = one hour", T.LongType()),
    ("type", "transaction type: CASH_IN, CASH_OUT, DEBIT, PAYMENT, TRANSFER", T.StringType()),
    ("amount", "transaction amount", T.DoubleType()),
    ("nameOrig", "sender id", T.StringType()),
    ("oldbalanceOrg", "sender balance before the transaction", T.DoubleType()),
    ("newbalanceOrig", "sender balance after the transaction", T.DoubleType()),
    ("nameDest", "receiver id", T.StringType()),
    ("oldbalanceDest", "receiver balance before the transaction", T.DoubleType()),
    ("newbalanceDest", "receiver balance after the transaction", T.DoubleType()),
    ("isFraud", "target: 1 = fraud", T.IntegerType()),
    ("isFlaggedFraud", "flagged by the bank's rule", T.IntegerType()),
]
SUSPICIOUS_TYPES = ["CASH_OUT", "TRANSFER"]
DROPPED_COLUMNS = ["nameOrig", "nameDest", "type", "isFlaggedFraud"]
LABEL = "isFraud"
# Script order of the 12 model features.
FEATURE_COLS = [
    "step", "type_encoded", "amount",
    "oldbalanceOrg", "newbalanceOrig",
    "oldbalanceDest", "newbalanceDest",
    "balance_diff_orig", "balance_diff_dest",
    "orig_zeroed", "suspicious_type", "amount_balance_error",
]
# Manager order: source order minus dropped columns, then the derived ones.
MANAGER_FEATURE_COLS = [
    "step", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest",
    "newbalanceDest", "type_encoded", "balance_diff_orig", "balance_diff_dest",
    "orig_zeroed", "suspicious_type", "amount_balance_error",
]
BINARY_FEATURES = ["orig_zeroed", "suspicious_type"]
CLASS_NAMES = {0: "Normal", 1: "Fraud"}
RISK_NAMES = {0: "Normal transaction", 1: "Fraud: small amount", 2: "Fraud: large amount"}
# -----------------------------------------------------------------------------

SOURCE_SCHEMA = T.StructType(
    [T.StructField(n, t, True, metadata={"comment": d}) for n, d, t in SOURCE_COLUMNS])

KEY = "row_key"
