"""Corpus pipeline over ``documents``: each stage is written and read again.

Quality classifier (rejected documents go), SimHash near-dedup (one document of
each group stays), benchmark decontamination (benchmark passages are cut out),
surrogates for personal data, best-fit packing into token sequences. All but
the last stage return the columns of ``documents``; ``n_chars`` follows a
changed text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.common import shared_folder, spare
from txrisk.llm.decontaminate import decontaminate
from txrisk.llm.packing import pack
from txrisk.llm.pii import pseudonymize
from txrisk.llm.quality import score_documents, train
from txrisk.llm.simhash import dedup

KEEP_SCORE = 0.3


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now (unchanged where the text is null)."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that score at least 0.3 (all, where nothing is labelled)."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = spare(docs, "score")
    return score_documents(docs, model, to=score).where(F.col(score) >= KEEP_SCORE).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each SimHash group."""
    return dedup(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut words inside benchmark windows out of the texts."""
    return _recounted(decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data."""
    return _recounted(pseudonymize(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place in it."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("benchmark_free", benchmark_free),
    ("surrogates", surrogates), ("packed", packed)]

# The classifier and the fingerprints are outside SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; each stage's rows are written as
    Parquet in the shared folder and reread as the next stage's input."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
