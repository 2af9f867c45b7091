"""SMOTE as Spark joins.

n_new = int(ratio * n_major) - n_minor synthetic rows (T13). Each draw i
picks a base minority row (uniform index), one of its k nearest minority
neighbours (exact kNN self-join without self) and a gap u in [0, 1):
``base + u * (neighbour - base)``. Draws come from md5 digests of i, so the
result does not depend on partitioning; indexes come from the bucketed exact
rank. Every step is an equi-join on a uniformly spread key (no hot key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import uniform
from ..schema import KEY, LABEL
from ..session import cut_lineage
from .knn import knn_join
from .sampling import check_sampler, class_count_dict, digest_rank, undersample


def smote(df: DataFrame, features: Sequence[str], label: str = LABEL, key: str = KEY,
          ratio: float = 0.1, k: int = 5, seed: int = 42, truncate_ints: bool = True) -> DataFrame:
    """Original rows plus synthetic minority rows (negative keys -1, -2, ...).

    ``truncate_ints``: integer feature columns are cast back to their type
    (truncation toward zero, T14) — the behaviour on a frame with int columns.
    """
    features = list(features)
    counts = class_count_dict(df, label)
    if len(counts) != 2:
        raise ValueError("SMOTE needs exactly two classes")
    minor = min(counts, key=lambda c: (counts[c], c))
    major = max(counts, key=lambda c: (counts[c], -c))
    n_min = counts[minor]
    n_new = int(ratio * counts[major]) - n_min
    if n_new < 0:
        raise ValueError(f"ratio {ratio} asks for fewer minority rows than exist")
    if n_min <= k:
        raise ValueError(f"SMOTE with k={k} needs more than {k} minority rows, got {n_min}")
    types = {f.name: f.dataType for f in df.schema.fields}
    # minority rows feed the kNN self-join, the index and the neighbour
    # lookup: write them once (they are the small class)
    mino = cut_lineage(df.where(F.col(label) == minor).select(key, *features))
    vecs = mino.select(F.col(key).alias("qid"), F.array(*[F.col(c).cast("double") for c in features]).alias("vec"))
    nn = knn_join(vecs, vecs.withColumnRenamed("qid", "tid"), k, "euclidean", "qid", "tid", "vec",
                  exclude_self=True)
    idx = digest_rank(mino, key, seed, [], "_idx")
    gen = df.sparkSession.range(n_new).select(F.col("id").alias("_i"))
    gen = gen.select("_i",
                     F.floor(uniform("_i", seed, "base") * n_min).cast("bigint").alias("_idx"),
                     (F.floor(uniform("_i", seed, "nb") * k) + 1).cast("int").alias("rank"),
                     uniform("_i", seed, "step").alias("_gap"))
    base = gen.join(idx, "_idx")
    base = base.join(nn.select(F.col("qid").alias(key), "rank", F.col("tid").alias("_nb")), [key, "rank"])
    nbf = mino.select(F.col(key).alias("_nb"), *[F.col(c).alias(f"_n_{c}") for c in features])
    base = base.join(nbf, "_nb")

    def synth(c):
        v = F.col(c).cast("double") + F.col("_gap") * (F.col(f"_n_{c}").cast("double") - F.col(c).cast("double"))
        t = types[c]
        if truncate_ints and t.typeName() in ("integer", "long", "short", "byte"):
            return v.cast(t).alias(c)
        return v.cast("double").alias(c) if t.typeName() != "double" else v.alias(c)

    new = base.select((-(F.col("_i") + 1)).cast(types[key]).alias(key), *[synth(c) for c in features],
                      F.lit(minor).cast(types[label]).alias(label))
    orig = df.select(key, *features, label)
    if not truncate_ints:
        orig = orig.select(key, *[F.col(c).cast("double").alias(c) for c in features], label)
    return orig.unionByName(new)


def balance(df: DataFrame, features: Sequence[str], sampler: str = "SMOTE", ratio: float = 0.1, seed: int = 42,
            label: str = LABEL, key: str = KEY) -> DataFrame:
    """Rebalance a (scaled) training frame by the named sampler; integers
    are not truncated, as scaled features hold none. Unknown names raise."""
    if check_sampler(sampler) == "SMOTE":
        return smote(df, features, label, key, ratio, seed=seed, truncate_ints=False)
    return undersample(df, label, ratio, seed, key).select(key, *features, label)
