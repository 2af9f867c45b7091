"""Best-fit packing of token sequences by fitted length patterns.

Documents become pieces of at most 1024 tokens. The histogram of piece lengths
(at most 1024 numbers, whatever the corpus) goes to the driver, which
enumerates the patterns of two to four present lengths that fill a sequence
exactly, fits their repeat counts to the histogram by non-negative least squares
(an active set, into which the patterns with the steepest gradient enter),
rounds them, fits again what is left, and packs the residuals best-fit
decreasing. Where that takes more sequences than best fit alone, best fit alone
is the plan. The plan says which ranks of a length go to which sequences; pieces
are ranked within their length by a salted, distributed count, so no length
needs one task.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import batches, frugal, save

SEQUENCE = 1024
END_ID = 2
WASTE = 0.001               # weight of free room in the fit, against a miss of the histogram
_BATCH = 128                # patterns that enter the fit at a time
_STEPS = 15                 # such steps, at most
_REFITS = 2                 # times that what rounding left is fitted again, at most
_MEMO = 400_000             # encoded chunks a task remembers before it starts anew
_UNSAFE_CUT = re.compile(r"\s \s")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"   # fixed by the vocabulary


class ChunkEncoder:
    """Ids of texts as little-endian bytes, remembered by blank-separated chunk.

    The vocabulary's pre-token pattern never joins what stands before and after
    a blank, unless white space is on both sides; such texts, and texts with a
    special string, are encoded whole. Chunks with characters beyond Latin-1
    are left to the tokenizer library, others to a faster encoder that is built
    from the same vocabulary.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        self.special = re.compile("|".join(map(re.escape, sorted(special)))) if special else None
        direct = [*range(33, 127), *range(161, 173), *range(174, 256)]   # byte-level alphabet
        spare = [b for b in range(256) if b not in set(direct)]
        byte_of = {chr(b): b for b in direct} | {chr(256 + k): b for k, b in enumerate(spare)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in self.library.get_vocab(False).items()
                 if token not in special}
        self.fast = tiktoken.Encoding("chunks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.first, self.later = {}, {}

    def _encode(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
            ids = self.fast.encode_ordinary(text)
        except UnicodeEncodeError:
            ids = self.library.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        if _UNSAFE_CUT.search(text) or self.special and self.special.search(text):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        head, *rest = text.split(" ")
        start = self.first.get(head)
        if start is None:
            start = self.first[head] = self._encode(head)
        ids = list(map(self.later.get, rest))
        if None in ids:
            for k, v in enumerate(ids):
                if v is None:
                    v = self.later.get(rest[k])
                    if v is None:
                        v = self.later[rest[k]] = self._encode(" " + rest[k])
                    ids[k] = v
        if len(self.first) + len(self.later) > _MEMO:
            self.first.clear()
            self.later.clear()
        return start + b"".join(ids)


def pieces_of(ids: bytes, limit: int = SEQUENCE):
    """(piece, start, length, crc32) of 4-byte ids; the first may be shorter."""
    n = len(ids) // 4
    parts = -(-n // limit)
    start = 0
    for k in range(parts):
        length = n - limit * (parts - 1) if k == 0 else limit
        yield k, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])
        start += length


def _pieces(path: str, end: bytes, limit: int, id_type: pa.DataType):
    schema = pa.schema([("id", id_type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def run(it):
        encoder = ChunkEncoder(path)
        for b in it:
            out: dict[str, list] = {f.name: [] for f in schema}
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for row in pieces_of(encoder.encode(t or "") + end, limit):
                    for name, v in zip(out, (i, *row)):
                        out[name].append(v)
            yield from batches(out, schema)
    return run


# ------------------------------------------------------------------ the plan
class Patterns:
    """All exact fills of ``limit`` by two to four of the present lengths.

    Pairs and triples are listed (at most limit^2 / 12 of them); quadruples are
    two pairs, and of the pairs of one sum only the best one matters to a price.
    """

    def __init__(self, present: np.ndarray, limit: int):
        self.limit, here = limit, np.zeros(limit + 1, bool)
        here[present] = True
        a, b = np.meshgrid(present, present, indexing="ij")
        once = a >= b
        a, b = a[once], b[once]
        self.a, self.b = a[a + b < limit], b[a + b < limit]        # pairs, by their sum
        self.sum = self.a + self.b
        c = limit - self.sum
        third = (c <= self.b) & here[c]
        two = present[2 * present >= limit]
        two = two[here[limit - two]]
        zero = np.zeros_like(two)
        self.listed = np.vstack([np.stack([two, limit - two, zero, zero], 1),
                                 np.stack([self.a, self.b, c, np.zeros_like(c)], 1)[third]])

    def steepest(self, price: np.ndarray, most: int) -> list[tuple[int, ...]]:
        """Patterns with the largest sums of ``price`` over their lengths, all
        positive, no two with a length in common."""
        price = price.copy()
        price[0] = 0
        rows, value = self.listed, price[self.listed].sum(axis=1)
        if len(self.sum):
            worth = price[self.a] + price[self.b]
            order = np.lexsort((worth, self.sum))
            last = order[np.flatnonzero(np.diff(self.sum[order], append=-1))]     # the best pair of each sum
            best = np.full(self.limit + 1, -1)
            best[self.sum[last]] = last
            s = np.arange(1, self.limit // 2 + 1)
            s = s[(best[s] >= 0) & (best[self.limit - s] >= 0)]
            p, q = best[s], best[self.limit - s]
            rows = np.vstack([rows, np.stack([self.a[p], self.b[p], self.a[q], self.b[q]], 1)])
            value = np.concatenate([value, worth[p] + worth[q]])
        found, used = [], set()
        top = np.argsort(-value, kind="stable")[:50 * most]
        for k in top[value[top] > 1e-9 * max(1.0, np.abs(price).max())]:
            pattern = tuple(sorted((int(v) for v in rows[k] if v), reverse=True))
            if not used & set(pattern):
                used |= set(pattern)
                found.append(pattern)
                if len(found) == most:
                    break
        return found


def fit_counts(hist: np.ndarray, patterns: Patterns, start: list[tuple[tuple[int, ...], int]]):
    """Patterns and counts x >= 0 minimising |A x - hist|^2 + (WASTE w x)^2, where
    A counts each length in each pattern and w is what a pattern leaves free.

    An active-set method: it begins with the patterns and counts of ``start``
    (a whole packing, which may leave room free); exact patterns with the
    steepest gradient enter, the passive set's least-squares solution is taken
    as far as all counts stay positive, those at zero leave.
    """
    limit, h = patterns.limit, np.append(hist.astype(float), 0.0)

    def rows(some):
        return np.array([np.append(np.bincount(p, minlength=len(hist)), WASTE * (limit - sum(p))) for p in some],
                        float).reshape(-1, len(h))

    chosen, x = [p for p, _ in start], np.array([n for _, n in start], float)
    a, error = rows(chosen), float(h @ h)
    for step in range(_STEPS):
        known = set(chosen)
        new = [p for p in patterns.steepest((h - x @ a)[:-1], _BATCH) if p not in known] if step else []
        if step and not new:
            break
        chosen, a, x = chosen + new, np.vstack([a, rows(new)]), np.concatenate([x, np.zeros(len(new))])
        gram, goal = a @ a.T, a @ h
        while len(x):
            z = np.linalg.solve(gram + 1e-7 * np.eye(len(x)), goal)
            if (z > 0).all():
                x = z
                break
            low = z <= 0
            size = (x[low] / np.maximum(x[low] - z[low], 1e-300)).min()
            x = x + size * (z - x)
            stay = ~(low & (x <= 1e-9 * max(1.0, x.max())))
            chosen = [p for p, s in zip(chosen, stay) if s]
            a, x, gram, goal = a[stay], x[stay], gram[np.ix_(stay, stay)], goal[stay]
        before, error = error, float(((h - x @ a) ** 2).sum())
        if step and error > 0.999 * before:
            break
    return chosen, x


def best_fit(left: np.ndarray, limit: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing over length counts; open[r] are groups with r free."""
    open_: list[list] = [[] for _ in range(limit + 1)]
    for length in range(limit, 0, -1):
        count = int(left[length])
        free = length
        while count and free <= limit:
            if not open_[free]:
                free += 1
                continue
            held, n = open_[free].pop()
            take = min(n, count)
            if n > take:
                open_[free].append((held, n - take))
            open_[free - length].append(((*held, length), take))
            count -= take
            free = length
        per = limit // length
        for k, n in ((per, count // per), (count % per, 1)):
            if k and n:
                open_[limit - k * length].append(((length,) * k, n))
    return [g for groups in open_ for g in groups]


def merged(bins):
    """Each pattern once, with all its repeats."""
    counts: dict[tuple[int, ...], int] = {}
    for lengths, n in bins:
        key = tuple(sorted(lengths, reverse=True))
        counts[key] = counts.get(key, 0) + n
    return sorted(counts.items())


def fitted_bins(left: np.ndarray, limit: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences by fitted patterns; takes their pieces out of ``left``.

    Counts are rounded to the nearest number that the pieces left allow, the
    largest first, so that rounding losses of one pattern go to the next; what is
    left is fitted again until no count reaches one half.
    """
    bins = []
    for _ in range(_REFITS):
        present = np.flatnonzero(left[:limit])
        if not len(present):
            break
        patterns, x = fit_counts(left, Patterns(present, limit), merged(best_fit(left, limit)))
        placed = 0
        for k in np.argsort(-x, kind="stable"):
            need = np.bincount(patterns[k], minlength=len(left))
            used = np.flatnonzero(need)
            n = int(min(np.floor(x[k] + 0.5), (left[used] // need[used]).min()))
            if n:
                bins.append((patterns[k], n))
                left[used] -= n * need[used]
                placed += n
        if not placed:
            break
    return bins


def pack_histogram(hist: np.ndarray, limit: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, repeats): together they use every piece once.
    Never more sequences than best fit alone."""
    left = hist.astype(np.int64).copy()
    full = [((limit,), int(left[limit]))] if left[limit] else []
    left[limit] = 0
    alone = best_fit(left, limit)
    bins = fitted_bins(left, limit)
    bins += best_fit(left, limit)
    return full + min(bins, alone, key=lambda plan: sum(n for _, n in plan))


def rank_table(bins: list[tuple[tuple[int, ...], int]], limit: int = SEQUENCE):
    """Per (length, first rank): first sequence and offset, as sorted arrays."""
    used = np.zeros(limit + 1, np.int64)
    rows, sequence = [], 0
    for lengths, n in bins:
        at = 0
        for length in lengths:
            rows.append((length, used[length], sequence, at))
            used[length] += n
            at += length
        sequence += n
    t = np.array(rows, np.int64).reshape(-1, 4)
    return t[np.lexsort((t[:, 1], t[:, 0]))]


_RANK_BITS = 50


def _place(table):
    def run(it):
        t = table.value
        key = (t[:, 0] << _RANK_BITS) | t[:, 1]
        for b in it:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            row = np.searchsorted(key, (length << _RANK_BITS) | rank, side="right") - 1
            add = [pa.array(t[row, 2] + rank - t[row, 1]), pa.array(t[row, 3])]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *add],
                                             names=[*b.schema.names[:-1], "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         limit: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``id_col, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its ids followed by ``end_id``; only one longer than
    ``limit`` is cut, its first piece taking the odd rest. Null and empty texts
    are the end id alone; null ids and repeated rows are packed like others;
    no other column is read; an empty table gives no piece.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("piece", T.IntegerType()),
                           *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))])
    end = array("I", [end_id]).tobytes()
    rows = save(docs.select(id_col, text_col).mapInArrow(
        frugal(_pieces(tokenizer_path, end, limit, to_arrow_type(kind))), schema), "pieces")
    hist = np.zeros(limit + 1, np.int64)
    for r in rows.groupBy("length").count().collect():      # at most ``limit`` rows
        hist[r[0]] = r[1]
    table = spark.sparkContext.broadcast(rank_table(pack_histogram(hist, limit), limit))
    salts = 256 + int(hist.max()) // 20_000
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy("length", "salt").agg(F.count("*").alias("n")) \
        .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    inside = Window.partitionBy("length", "salt").orderBy("id", "piece", "ids_crc32")
    ranked = salted.withColumn("nth", F.row_number().over(inside)).join(offsets, ["length", "salt"]) \
        .select("id", "piece", "start", "length", "ids_crc32", (F.col("skip") + F.col("nth") - 1).alias("rank"))
    out = T.StructType([*schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(_place(table), out).withColumnRenamed("id", id_col)
