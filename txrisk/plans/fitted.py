"""P1 + M17 as one fitted pipeline: encoding, derived features, vector, model.

A fitted pipeline takes raw transactions (batch or stream) and is saved to and
loaded from the shared folder, so scoring needs nothing of the training run.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as fe
from ..operators.estimators import PopulationScaler
from ..schema import FEATURE_COLS, RISK_NAMES, SUSPICIOUS_TYPES
from ..session import checkpoint_dir

_SUSPICIOUS = ", ".join(f"'{t}'" for t in SUSPICIOUS_TYPES)
# P2-P6 as a statement; an unknown comparison counts as false.
DERIVED_SQL = f"""SELECT *, newbalanceOrig - oldbalanceOrg AS balance_diff_orig,
  newbalanceDest - oldbalanceDest AS balance_diff_dest,
  CAST(coalesce(oldbalanceOrg > 0 AND newbalanceOrig = 0, false) AS INT) AS orig_zeroed,
  CAST(coalesce(type IN ({_SUSPICIOUS}), false) AS INT) AS suspicious_type,
  abs(amount + (newbalanceOrig - oldbalanceOrg)) AS amount_balance_error FROM __THIS__"""


def transaction_pipeline(model: Estimator, features: Sequence[str] = FEATURE_COLS, scaled: bool = False) -> Pipeline:
    """Unfitted: alphabetical type codes (unknown and NULL types get the code
    after the last, T5), derived features, feature vector, scaling, ``model``
    (on the column ``features``)."""
    raw = "raw" if scaled else "features"
    stages = [StringIndexer(inputCol="type", outputCol="type_encoded", stringOrderType="alphabetAsc", handleInvalid="keep"),
              SQLTransformer(statement=DERIVED_SQL),
              VectorAssembler(inputCols=list(features), outputCol=raw, handleInvalid="keep")]
    return Pipeline(stages=[*stages, *([PopulationScaler(inputCol=raw, outputCol="features")] if scaled else []), model])


def save_fitted(model: PipelineModel, spark: SparkSession, path: str | None = None) -> str:
    """Save under ``path``, or under a new name in the shared folder."""
    if path is None:
        folder = checkpoint_dir(spark)
        if folder is None:
            raise ValueError("set spark.checkpoint.dir or name a path")
        path = os.path.join(folder, f"fitted-{uuid.uuid4().hex}")
    model.save(path)
    return path


def load_fitted(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_risk(model: PipelineModel, tx: DataFrame) -> DataFrame:
    """Raw transactions plus ``risk_category, risk_name, flag`` and the
    three class probabilities. A projection only: also for streams."""
    p, code = vector_to_array(F.col("probability")), F.col("prediction").cast("int")
    extra = {"risk_category": code, "risk_name": fe.code_to_name(code, RISK_NAMES),
             "flag": F.when(code > 0, "FRAUD").otherwise("NORMAL"),
             "p_normal": p[0], "p_small": p[1], "p_large": p[2]}
    return model.transform(tx).withColumns(extra).select(*tx.columns, *[c for c in extra if c not in tx.columns])
