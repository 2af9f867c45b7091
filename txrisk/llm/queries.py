"""The registered queries of this subpackage: thin, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql
from .conversations import repair_conversations
from .decontaminate import contaminated_spans
from .licenses import license_scan
from .packing import pack
from .pii import pseudonymize
from .quality import held_out, score_documents, train
from .repeats import repeated_bytes
from .simhash import simhash_groups
from .token_counts import token_counts
from .url_filter import url_verdicts
from .vector_links import vector_links
from .warc import warc_roundtrip
from .whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn, oracle: str | None = None):
    QUERIES[fn.__name__] = fn
    if oracle is not None:
        ORACLE[fn.__name__] = oracle
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op10_token_counts(spark, sf_dir):
    """Tokens of every document under the 32k piece model; limit 4,096."""
    out = token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.withColumn("over_limit", F.col("n_tokens") > 4096)

@partial(register, oracle=sql.DECONTAMINATE)
def op8_decontaminate(spark, sf_dir):
    """Words of every document inside 10-word windows of the benchmark."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contaminated_spans(docs, _table(spark, sf_dir, "benchmark"))
    n_hit = F.expr("cast(aggregate(spans, 0L, (s, x) -> s + x.end - x.start) as long)")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


@register
def op3_simhash(spark, sf_dir):
    """Near-duplicate groups of documents: 64-bit SimHash, links at 2 bits or fewer."""
    return simhash_groups(_table(spark, sf_dir, "documents"))


@register
def op7_licenses(spark, sf_dir):
    """License phrases and notices in every document."""
    return license_scan(_table(spark, sf_dir, "documents"))


@register
def op5_quality(spark, sf_dir):
    """Quality score of every document; label 1 predicted from 0.3 up."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, _table(spark, sf_dir, "labels"))
    return score_documents(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register
def op1_packing(spark, sf_dir):
    """All documents packed into sequences of at most 1,024 tokens."""
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@partial(register, oracle=sql.WARC)
def op6_warc(spark, sf_dir):
    """Pages written as WARC records and read back along verified boundaries."""
    return warc_roundtrip(_table(spark, sf_dir, "pages"))


@partial(register, oracle=sql.VECTOR_LINKS)
def op9_vector_links(spark, sf_dir):
    """Embeddings linked at cosine 0.9 or more, with their components."""
    return vector_links(_table(spark, sf_dir, "embeddings"))


@register
def op2_pii(spark, sf_dir):
    """Documents with personal data replaced by surrogates, and how many mentions."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize(docs, count_col="n_replaced").withColumn("changed", F.col("n_replaced") > 0)


@partial(register, oracle=sql.REPEATS)
def op4_repeats(spark, sf_dir):
    """Bytes of every document covered by 50-byte strings of earlier documents."""
    return repeated_bytes(_table(spark, sf_dir, "documents"))


@partial(register, oracle=sql.URL_VERDICTS)
def op13_url_filter(spark, sf_dir):
    """Every page judged by the URL list; pages that no entry fits are allowed."""
    rules = spark.createDataFrame(sql.URL_RULES, "host string, path string, verdict string")
    return url_verdicts(_table(spark, sf_dir, "pages"), rules)


@register
def op12_whitening(spark, sf_dir):
    """Embeddings as integers, whitened along their 16 leading components."""
    return whiten(_table(spark, sf_dir, "embeddings"))


@partial(register, oracle=sql.CONVERSATIONS)
def op11_conversations(spark, sf_dir):
    """Conversations damaged, their faults counted and repaired at the least cost."""
    return repair_conversations(_table(spark, sf_dir, "conversations"))
