"""S1, S3, S5-S7 and the streaming scoring path."""

import os
import tempfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from txrisk.operators import features as fe
from txrisk.operators import models as mo
from txrisk.schema import FEATURE_COLS, KEY
from txrisk.sources import transactions as src
from txrisk.streaming.scoring import events_stream, score_stream


def test_csv_scan_with_fixed_schema(spark):
    tx = src.load_tx(spark, SF_SMALL).drop(KEY)
    out = os.path.join(tempfile.mkdtemp(prefix="txrisk-csv-"), "tx")
    tx.write.option("header", True).csv(out)
    back = src.load_transactions(spark, out, "csv")
    assert back.schema == src.SOURCE_SCHEMA or [f.name for f in back.schema] == [f.name for f in src.SOURCE_SCHEMA]
    assert back.count() == tx.count()
    assert back.exceptAll(tx).count() == 0


def test_csv_failfast_on_bad_row(spark):
    d = tempfile.mkdtemp(prefix="txrisk-bad-")
    with open(os.path.join(d, "bad.csv"), "w") as fh:
        fh.write(",".join(f.name for f in src.SOURCE_SCHEMA) + "\n")
        fh.write("notanumber,PAYMENT,1.0,C1,1.0,0.0,M1,0.0,0.0,0,0\n")
    with pytest.raises(Exception):
        src.load_transactions(spark, d, "csv").collect()


def test_missing_path(spark):
    with pytest.raises(AnalysisException):
        src.load_transactions(spark, "/nonexistent/txrisk/path.csv", "csv")


def test_shape_preview_dictionary(spark):
    tx = src.load_tx(spark, SF_SMALL)
    r = src.shape(tx.drop(KEY)).first()
    assert (r["rows"], r["columns"]) == (1000, 11)
    assert [x[KEY] for x in src.preview(tx, 3).collect()] == [0, 1, 2]
    assert src.data_dictionary(spark).count() == 11


def test_literal_rows_encode_through_fitted_mapping(spark):
    tx = src.load_tx(spark, SF_SMALL)
    cats = fe.fit_type_codes(tx)
    rows = fe.engineer_features(src.new_transactions(spark), cats, drop=False).orderBy("tx_id").collect()
    assert [r["type_encoded"] for r in rows] == [4, 1, 4, 3]          # PAYMENT is 3, not the literal 2 (T2)
    assert [r["amount_balance_error"] for r in rows] == [0.0, 0.0, 0.0, 0.0]
    assert [r["orig_zeroed"] for r in rows] == [1, 1, 1, 0]


def test_stream_scoring_matches_batch(spark):
    tx = src.load_tx(spark, SF_SMALL)
    cats = fe.fit_type_codes(tx)
    feat = mo.assemble(fe.feature_table(tx, cats).withColumnRenamed("isFraud", "label"), FEATURE_COLS)
    model = mo.decision_tree(5).fit(feat)
    stream = events_stream(spark, SF_SMALL)
    scored = score_stream(stream, cats, model).select(KEY, "prediction")
    q = scored.writeStream.format("memory").queryName("txrisk_scored").outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.table("txrisk_scored")
    want = mo.predict_binary(model, feat).select(KEY, "prediction")
    assert got.count() == 1000
    assert got.exceptAll(want).count() == 0
