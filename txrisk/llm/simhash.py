"""SimHash near-duplicates with Golay-code fuzzy keys.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits (the last one
padded with zeros). Two fingerprints at most two bits apart agree in at least
one segment (three segments, two errors) and differ by at most two bits in the
next one. The perfect (23, 12) Golay code gives each segment the codeword
indices within reach of its one-bit neighbours (one index, or six): segments
at distance two or less always share one. So equal (segment, next segment's
codeword index) keys find every pair; the join verifies the distance.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import frugal, save, spare
from .graph import components

SHINGLE = 3
MAX_BITS = 2                # what the key scheme covers
HOT_KEY = 2048              # fingerprints under one key before it is refined
_GENERATOR = 0b110001110101  # x^11+x^10+x^6+x^5+x^4+x^2+1, fixed by the code
_SEGMENTS = ((0, 23), (23, 23), (46, 18))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles; 0 without words."""
    import xxhash
    w = (text or "").encode().lower().split()      # bytes: A-Z and ASCII space only
    if not w:
        return 0
    joined = b" ".join(w)
    ends = list(accumulate(len(x) + 1 for x in w))
    starts = [0, *ends]
    size = min(shingle, len(w))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b - 1], 42) for a, b in zip(starts, ends[size - 1:])], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 4096):
        part = h[i:i + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(h), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


@lru_cache(1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(syndrome of the low 12 bits, of the high 11, error pattern by syndrome)."""
    def rest(v: int) -> int:
        for k in range(22, 10, -1):
            if v >> k & 1:
                v ^= _GENERATOR << (k - 11)
        return v
    low = np.array([rest(v) for v in range(1 << 12)], np.int64)
    high = np.array([rest(v << 12) for v in range(1 << 11)], np.int64)
    error = np.zeros(1 << 11, np.int64)
    for weight in range(4):
        for places in combinations(range(23), weight):
            e = sum(1 << p for p in places)
            error[rest(e)] = e
    return low, high, error


def codeword_index(v: np.ndarray) -> np.ndarray:
    """Index (12 message bits) of the codeword nearest to each 23-bit word."""
    low, high, error = _golay()
    return (v ^ error[low[v & 4095] ^ high[v >> 12]]) >> 11


def fuzzy_indices(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) pairs: the distinct codeword indices near each word."""
    flips = np.concatenate([[0], 1 << np.arange(23)])
    near = np.sort(codeword_index(v[:, None] ^ flips), axis=1)
    new = np.concatenate([np.ones((len(v), 1), bool), near[:, 1:] != near[:, :-1]], axis=1)
    row, col = np.nonzero(new)
    return row, near[row, col]


def _segment(fp: np.ndarray, k: int) -> np.ndarray:
    shift, width = _SEGMENTS[k]
    return ((fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)


def _keys(it):
    for b in it:
        fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for k in range(3):
            row, index = fuzzy_indices(_segment(fp, (k + 1) % 3))
            key = (k << 35) | (_segment(fp, k)[row] << 12) | index
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row].view(np.int64))], names=["key", "fp"])


def _refine(it):
    """Key rows of hot keys -> also keyed by the third segment's indices."""
    for b in it:
        key = b.column(0).to_numpy()
        fp = b.column(1).to_numpy().view(np.uint64)
        third = np.zeros(len(key), np.int64)
        for k in range(3):
            third = np.where(key >> 35 == k, _segment(fp, (k + 2) % 3), third)
        row, index = fuzzy_indices(third)
        yield pa.RecordBatch.from_arrays([pa.array((key[row] << 12) | index), pa.array(fp[row].view(np.int64))],
                                         names=["key", "fp"])


def _verified(keys: DataFrame) -> DataFrame:
    a, b = keys.select("key", F.col("fp").alias("a")), keys.select("key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    return a.join(b, (a.key == b.key) & (F.col("a") < F.col("b")) & near).select("a", "b")


def near_pairs(fps: DataFrame, hot_key: int = HOT_KEY) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints (column ``fp``) 1 or 2 bits apart.

    Keys that hold more than ``hot_key`` fingerprints are refined by the
    indices of the remaining segment (also within two errors): nothing is lost.
    """
    keys = save(fps.mapInArrow(_keys, "key long, fp long"), "fuzzy-keys")
    hot = save(keys.groupBy("key").count().where(F.col("count") > hot_key).select("key"), "hot-keys")
    cold = keys.join(hot, "key", "left_anti")
    fine = keys.join(hot, "key", "left_semi").select("key", "fp").mapInArrow(_refine, "key long, fp long")
    return _verified(cold).unionByName(_verified(fine)).distinct()


def _row_key(id_col: str, text_col: str):
    """Digest of a row's id and text (null id kept apart, null text as empty)."""
    return F.md5(F.concat(F.coalesce(F.concat(F.lit("i"), F.col(id_col).cast("string")), F.lit("n")),
                          F.lit("\x00"), F.coalesce(text_col, F.lit(""))).cast("binary"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, hot_key: int) -> DataFrame:
    """Every row's ``id_col, row, fp`` and its group's first row ``first``:
    smallest id (nulls last), then smallest row digest."""
    def prints(it):
        for b in it:
            fp = np.array([fingerprint(t, shingle) for t in b.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             names=[id_col, "row", "fp"])

    rows = docs.select(id_col, _row_key(id_col, text_col).alias("row"), text_col)
    kind = rows.schema[id_col].dataType.simpleString()
    marked = save(rows.mapInArrow(frugal(prints), f"`{id_col}` {kind}, row string, fp long"), "fingerprints")
    first = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col("row"))
    classes = save(marked.groupBy("fp").agg(F.min(first).alias("first")), "classes")
    found = components(near_pairs(classes.select("fp"), hot_key), "a", "b")
    group = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("component", F.coalesce("component", "fp"))
    least = group.groupBy("component").agg(F.min("first").alias("group_first"))
    label = group.join(least, "component").select("fp", F.col("group_first").alias("first"))
    return marked.join(label, "fp")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE, hot_key: int = HOT_KEY) -> DataFrame:
    """``id_col, fingerprint`` (hex), ``component_id``: one row per row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most two
    bits, itself included. Null and empty texts have fingerprint zero and link
    like any other. A row with a null id is grouped too; it gives no smallest
    id (a group of such rows has component_id null). Repeated rows share
    fingerprint and group. Other columns are not read; no rows give no rows.
    """
    return _grouped(docs, id_col, text_col, shingle, hot_key).select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.id").alias("component_id"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Keep one row of each group: smallest id (nulls last), then smallest
    digest of id and text; of equal rows one stays. Columns as given."""
    groups = _grouped(docs.select(id_col, text_col), id_col, text_col, shingle, HOT_KEY)
    row, nth = spare(docs, "row"), spare(docs, "nth")
    keep = groups.where("row = first.row").select(F.col("row").alias(row)).distinct()
    one = Window.partitionBy(row).orderBy(F.lit(1))
    return docs.withColumn(row, _row_key(id_col, text_col)).join(keep, row, "left_semi") \
        .withColumn(nth, F.row_number().over(one)).where(F.col(nth) == 1).select(*docs.columns)
