"""Scoring a transaction *stream* with fitted parameters.

Feature derivation with a fixed type mapping, scaling with fixed statistics
and ``Model.transform`` are all stateless projections, so the batch
functions apply unchanged to a streaming DataFrame (no global sort, window
or aggregation involved). This module only wires them together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators import features as fe
from ..operators import models as mo
from ..operators import scaling as sc
from ..schema import FEATURE_COLS
from ..sources.transactions import tx_from_events


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    """New ``events*.parquet`` files under ``sf_dir`` as a stream (schema
    taken from the batch table)."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(f"{sf_dir}/events*.parquet"))


def score_stream(stream: DataFrame, cats: list[str], model, scaler: sc.ScalerStats | None = None,
                 features: Sequence[str] = FEATURE_COLS, from_events: bool = True) -> DataFrame:
    """Derive features, optionally scale, apply a fitted binary model."""
    tx = tx_from_events(stream) if from_events else stream
    feat = fe.engineer_features(tx, cats, drop=False)
    if scaler:
        feat = sc.apply_scaler(feat, scaler)
    return mo.predict_binary(model, mo.assemble(feat, list(features)))
