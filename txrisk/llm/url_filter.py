"""URL lists: a blocked Bloom filter lets possible hits through to an exact join.

A list holds canonical URLs (host, path), each with a verdict. An entry fits a
page whose host is the entry's host or a subdomain of it and whose path begins
with the entry's path; the longest entry wins. The keys a page could meet are
the ends of its host, by the numbers of labels that the list has, and for each
of them the beginnings of its path, by the path lengths that the list has.

The list's hosts and entries are hashed into a blocked Bloom filter: one block
of eight 64-bit words a key, one bit in each word, so that a probe reads one
cache line. Host ends are probed first, path beginnings only for the hosts that
passed. What passes both is joined exactly with the list, which removes the
false positives; pages without a passing key never meet a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import save, spare

WORDS = 8                   # 64-bit words of a block
KEYS_PER_BLOCK = 32         # 16 bits a key
MAX_BLOCKS = 1 << 20        # 64 MiB: beyond it the filter only gets less sharp
HOT_SHARE = 1000            # keys with over 1/1000 of all candidates (so fewer than 1,000) are joined apart
ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*+)", 1)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, r"\A[^/?#]*+([^?#]*+)", 1)


def hashes(*key: Column) -> tuple[Column, Column]:
    """Two hashes of a key: the block's and the bits'."""
    return F.xxhash64(F.lit("block"), *key), F.xxhash64(F.lit("bits"), *key)


def _probe(words: np.ndarray, at: np.ndarray, bits: np.ndarray) -> np.ndarray:
    row, bits = np.mod(at, len(words)), bits.view(np.uint64)
    hit = np.ones(len(row), bool)
    for k in range(WORDS):
        hit &= (words[row, k] >> ((bits >> np.uint64(6 * k)) & np.uint64(63))) & np.uint64(1) == 1
    return hit


class BlockedBloom:
    """The filter as a broadcast array of blocks; ``passing`` filters arrays of keys."""

    def __init__(self, spark, words: np.ndarray):
        self.bytes = words.nbytes
        self.held = spark.sparkContext.broadcast(words)

    @staticmethod
    def of(keys: DataFrame, max_blocks: int = MAX_BLOCKS) -> "BlockedBloom":
        """Filter of the rows ``at, bits`` (hashes). Blocks are made on the
        executors; at most ``max_blocks`` of them reach the driver."""
        n = min(max_blocks, max(1, -(-keys.count() // KEYS_PER_BLOCK)))
        bit = [F.expr(f"shiftleft(1L, cast(shiftright(bits, {6 * k}) & 63 as int))") for k in range(WORDS)]
        blocks = keys.groupBy(F.pmod("at", F.lit(n)).alias("block")) \
            .agg(*(F.bit_or(b).alias(f"w{k}") for k, b in enumerate(bit))).toArrow()
        words = np.zeros((n, WORDS), np.int64)
        at = blocks.column("block").to_numpy()
        for k in range(WORDS):
            words[at, k] = blocks.column(f"w{k}").to_numpy()
        return BlockedBloom(keys.sparkSession, words.view(np.uint64))

    def holds(self, at: Column, bits: Column) -> Column:
        """Whether a key may be in the filter: never false for one that is."""
        held = self.held

        @F.arrow_udf("boolean")
        def probe(at: pa.Array, bits: pa.Array) -> pa.Array:
            return pa.array(_probe(held.value, at.to_numpy(), bits.to_numpy()))

        return probe(at, bits)

    def passing(self, df: DataFrame, name: str, keys: Column) -> DataFrame:
        """``df`` with only those elements left in the array ``name`` whose hash
        in the array ``keys`` (of structs ``at, bits``, in step) is in the filter."""
        held, probed = self.held, spare(df, "probed")
        asked = df.withColumn(probed, keys)
        out = T.StructType([*df.schema.fields, T.StructField(probed, T.ArrayType(T.BooleanType()))])
        names = out.names

        def run(it):
            words = held.value
            for b in it:
                keys = b.column(b.num_columns - 1)
                flat, sizes = keys.flatten(), np.diff(keys.offsets.to_numpy())
                hit = _probe(words, flat.field(0).to_numpy(), flat.field(1).to_numpy())
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(hit))],
                                                 names=names)

        both = F.arrays_zip(F.col(name).alias("v"), F.col(probed).alias("hit"))
        kept = F.transform(F.filter(both, lambda x: x["hit"]), lambda x: x["v"])
        return asked.mapInArrow(run, out).withColumn(name, kept).drop(probed)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def listed(rules: DataFrame) -> DataFrame:
    """``host, path, verdict`` with canonical hosts, one row per key.

    Rows without host or verdict are left out, a null path is empty; of rows
    that list a key twice a ``block`` counts before an ``allow``.
    """
    return rules.where("host is not null and verdict is not null") \
        .select(F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                F.col("verdict").cast("string").alias("verdict")) \
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))


def candidates(pages: DataFrame, rules: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``pages`` (with ``host, path``) plus ``keys``: the (host, path) keys of
    each row that passed the filter, false positives included, none missed."""
    at, bits = hashes(F.col("host"))
    full_at, full_bits = hashes(F.col("host"), F.col("path"))
    keys = rules.select(at.alias("at"), bits.alias("bits")).distinct() \
        .unionByName(rules.select(full_at.alias("at"), full_bits.alias("bits")))
    bloom = BlockedBloom.of(keys, max_blocks)
    # At most as many numbers as a listed host has labels and a listed path has characters.
    shapes = rules.select(F.collect_set(_labels(F.col("host"))).alias("labels"),
                          F.collect_set(F.length("path")).alias("lengths")).first()
    labels, lengths = (F.array([F.lit(v) for v in sorted(s)]).cast("array<int>")
                       for s in (shapes.labels, shapes.lengths))

    def hashed(pair):
        return F.struct(pair[0].alias("at"), pair[1].alias("bits"))

    ends = F.transform(F.filter(labels, lambda k: k <= _labels(F.col("host"))),
                       lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k))
    rows = bloom.passing(pages.withColumn("ends", ends), "ends", F.transform("ends", lambda h: hashed(hashes(h))))
    pairs = F.flatten(F.transform("ends", lambda h: F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")),
        lambda n: F.struct(h.alias("host"), F.substr("path", F.lit(1), n).alias("path")))))
    return bloom.passing(rows.withColumn("keys", pairs).drop("ends"), "keys", F.transform(
        "keys", lambda p: hashed(hashes(p["host"], p["path"]))))


def url_verdicts(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 default: str = ALLOW, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has ``host, path, verdict``; its size is free, only the filter is
    broadcast (at most ``max_blocks`` blocks of 64 bytes). ``rule`` is the
    host and path of the longest fitting entry (of equal lengths that with the
    longer host), null where none fits; then the verdict is ``default``.
    Null urls and urls without ``://`` have empty host and path; null ids and
    repeated rows are judged row by row; no other column is read; without rules
    every row gets ``default``; an empty table gives an empty result.
    """
    host, path = canonical(F.col("url"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")) \
        .select("id", host.alias("host"), path.alias("path"))
    rules = save(listed(rules), "url-rules")
    nothing = F.lit(None).cast("string")
    if rules.isEmpty():
        return rows.select(F.col("id").alias(id_col), "host", "path", nothing.alias("rule"),
                           F.lit(default).alias("verdict"))
    rows = save(candidates(rows, rules, max_blocks).withColumn("uid", F.monotonically_increasing_id()), "url-candidates")
    hits = rows.where(F.size("keys") > 0).select("uid", F.explode("keys").alias("key")).select("uid", "key.*")
    # A key that a large part of the pages meets (a whole top-level domain) would
    # be one join partition: such keys, fewer than HOT_SHARE, are broadcast.
    counts = hits.groupBy("host", "path").count()
    total = hits.count()
    hot = save(counts.where(F.col("count") * HOT_SHARE > total).join(rules, ["host", "path"], "left")
               .select("host", "path", "verdict"), "url-hot")
    common = hits.join(F.broadcast(hot), ["host", "path"])
    rest = hits.join(F.broadcast(hot.select("host", "path")), ["host", "path"], "left_anti") \
        .join(rules.hint("shuffle_hash"), ["host", "path"])
    found = common.where("verdict is not null").select("uid", "host", "path", "verdict") \
        .unionByName(rest.select("uid", "host", "path", "verdict"))
    order = F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
                     F.concat("host", "path").alias("rule"), "verdict")
    best = found.groupBy("uid").agg(F.max(order).alias("best"))
    return rows.join(best, "uid", "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
