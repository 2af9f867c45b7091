"""Removal of repeated 50-byte strings by sparse, distributed prefix doubling.

A string is repeated if it also starts in a document with a smaller id. Full
prefix doubling would move a (position, rank pair) row for every byte of the
corpus and round. Here a rank is a 64-bit name that all tasks derive alike, and
only positions that can still matter take part in a round:

1. 28-byte prefixes at sampled positions (every 50-byte string holds one whose
   place depends on its bytes alone); positions unique at that length drop out;
2. the stretch of strings around a sampled position, doubled in length: a
   stretch that stands in an earlier document is repeated as a whole; a
   position with just one such stretch in the corpus needs nothing more;
3. what is left, position by position: Spark sorts rows of position and rank
   pair, the ranks of the 28 bytes at a position and at 22 bytes on, which
   together are the 50-byte string, and the least document of equal pairs.

In rounds 1 and 2 the names are sorted within blocks of documents, grouped by
name range on Spark, compared over all blocks, and answered with a bit a name.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import save, shared_folder

LENGTH = 50
_K, _W, _T = 28, 23, 5              # sampled prefix, strings per sample window, bytes that pick the sample
BLOCK = 8 << 20                     # text bytes of a block
_SLICE = 1 << 16                    # bytes named at a time (long texts are sliced, overlapping)
_PER_RANGE = 200_000                # names of a round per name range, about
_NO_ID = np.iinfo(np.int64).max     # order of a document without id
_BASE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))   # any odd numbers
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))    # odd multipliers of a finaliser


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


_LETTER = [_mix(np.arange(1, 257, dtype=np.uint64) * b) for b in _BASE]


class _Powers:
    """Powers of the bases and of their inverses modulo 2^64."""

    def __init__(self, n: int):
        self.up, self.down = [], []
        for b in _BASE:
            inverse = np.uint64(pow(int(b), -1, 1 << 64))
            for out, v in ((self.up, b), (self.down, inverse)):
                p = np.full(n, v, np.uint64)
                p[0] = 1
                out.append(np.cumprod(p))


class Names:
    """Names of substrings of a buffer, from prefix sums of letter * base^place."""

    def __init__(self, buf: np.ndarray, powers: _Powers, checks: bool = True):
        self.p, self.sums = powers, []
        for k in range(2 if checks else 1):
            s = np.zeros(len(buf) + 1, np.uint64)
            np.cumsum(_LETTER[k][buf] * powers.up[k][:len(buf)], out=s[1:])
            self.sums.append(s)

    def everywhere(self, length: int) -> np.ndarray:
        """Plain (less mixed) names of all substrings of one length, in order."""
        s, n = self.sums[0], len(self.sums[0]) - length
        raw = (s[length:] - s[:-length]) * self.p.down[0][:n]
        return (raw ^ (raw >> np.uint64(32))) * _MIX[1]

    def of(self, start: np.ndarray, end: np.ndarray, k: int = 0) -> np.ndarray:
        raw = (self.sums[k][end] - self.sums[k][start]) * self.p.down[k][start]
        return _mix(raw + (end - start).astype(np.uint64))

    def check(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.of(start, end, 1) >> np.uint64(32)).astype(np.uint32)


def _sampled(buf: np.ndarray, names: Names) -> np.ndarray:
    """For each string start i the sampled position inside it: it depends only
    on the string's bytes (smallest 5-byte name, its place modulo the window)."""
    low = names.everywhere(_T) & ~np.uint64(0xFFFFFFFF)
    low |= np.arange(len(low), dtype=np.uint64)
    reach, need = 1, LENGTH - _T + 1
    while reach < need:
        step = min(reach, need - reach)
        low = np.minimum(low[:-step], low[step:])
        reach += step
    i = np.arange(len(low))
    return i + ((low & np.uint64(0xFFFFFFFF)).astype(np.int64) - i) % _W


class Block:
    """Stretches (runs of string starts with one sampled position) of a block's
    texts: document number, first and last start, sample name, stretch name."""

    def __init__(self, texts: list[bytes], order: np.ndarray, checks: bool = True):
        self.texts, self.order, self.checks = texts, order, checks
        parts, held, size = [], [], 0
        self.powers = _Powers(_SLICE + 2 * LENGTH)
        for d, t in enumerate(texts):
            for a in range(0, max(0, len(t) - LENGTH + 1), _SLICE):
                piece = t[a:a + _SLICE + LENGTH - 1]
                if size + len(piece) > _SLICE + LENGTH and held:
                    parts.append(self._stretches(held))
                    held, size = [], 0
                held.append((d, a, piece))
                size += len(piece)
        if held:
            parts.append(self._stretches(held))
        empty = [np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.uint32)]
        self.doc, self.lo, self.hi, self.sample, self.stretch, self.check = \
            (np.concatenate(c) for c in zip(*parts)) if parts else empty
        self.samples, self.sample_of = np.unique(self.sample, return_inverse=True)
        # Samples that stand in more than one document of this block.
        d = order[self.doc]
        least = np.full(len(self.samples), _NO_ID, np.int64)
        most = np.full(len(self.samples), np.iinfo(np.int64).min, np.int64)
        np.minimum.at(least, self.sample_of, d)
        np.maximum.at(most, self.sample_of, d)
        self.shared_here = least < most

    def _stretches(self, held):
        buf = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
        names = Names(buf, self.powers, self.checks)
        sizes = np.array([len(p) for _, _, p in held])
        begin = sizes.cumsum() - sizes
        at = _sampled(buf, names)
        # Stretches end where the sample changes and after a piece's last string.
        cut = np.concatenate([[True], at[1:] != at[:-1]])
        over = begin + sizes - LENGTH + 1
        cut[begin] = True
        cut[over[over < len(at)]] = True
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(at)) - 1
        piece = np.searchsorted(begin, first, side="right") - 1
        inside = first < over[piece]
        first, last, piece = first[inside], last[inside], piece[inside]
        a = at[first]
        stretch = names.of(first, last + LENGTH) ^ _mix((a - first).astype(np.uint64) + np.uint64(1))
        doc, offset = np.array([h[0] for h in held]), np.array([h[1] for h in held])
        shift = (offset - begin)[piece]
        check = names.check(first, last + LENGTH) if self.checks else np.zeros(len(first), np.uint32)
        return doc[piece], first + shift, last + shift, names.of(a, a + _K), stretch, check

    def strings(self, pick: np.ndarray):
        """(run, start, rank pair, check) of every string in the picked stretches."""
        out = []
        for lo in range(0, len(pick), 640):
            runs = pick[lo:lo + 640]
            texts = [self.texts[self.doc[r]][self.lo[r]:self.hi[r] + LENGTH] for r in runs]
            sizes = np.array([len(t) for t in texts])
            counts = sizes - LENGTH + 1
            begin = sizes.cumsum() - sizes
            buf = np.frombuffer(b"".join(texts), np.uint8)
            powers = self.powers if len(buf) <= len(self.powers.up[0]) else _Powers(len(buf))
            names = Names(buf, powers)
            inside = np.arange(counts.sum()) - np.repeat(counts.cumsum() - counts, counts)
            at = np.repeat(begin, counts) + inside
            out.append((np.repeat(runs, counts), np.repeat(self.lo[runs], counts) + inside,
                        names.of(at, at + _K), names.of(at + LENGTH - _K, at + LENGTH), names.check(at, at + LENGTH)))
        kinds = (np.int64, np.int64, np.uint64, np.uint64, np.uint32)
        return tuple(np.concatenate(c) for c in zip(*out)) if out else tuple(np.zeros(0, t) for t in kinds)


# ------------------------------------------------------- names on the wire
def _planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, so that the shuffle's compression
    finds the zeros of small numbers."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def _unplanes(raw: bytes, n: int, dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(-1, n).T).view(dtype).ravel()


def _packed(name: np.ndarray, *columns: np.ndarray) -> bytes:
    """Sorted names as differences, then the columns, all in byte planes."""
    steps = np.diff(name, prepend=np.uint64(0))
    return b"".join([len(name).to_bytes(4, "little"), _planes(steps), *map(_planes, columns)])


def _unpacked(raw: bytes, *dtypes):
    n, at, out = int.from_bytes(raw[:4], "little"), 4, []
    for k, t in enumerate(("<u8", *dtypes)):
        width = np.dtype(t).itemsize * n
        x = _unplanes(raw[at:at + width], n, t)
        out.append(np.cumsum(x, dtype=np.uint64) if k == 0 else x)
        at += width
    return out


def _requests(kind: int, block: int, bits: int, name: np.ndarray, *columns: np.ndarray):
    """Rows (kind, range, block, names): names sorted, cut into 2^bits ranges."""
    which = (name >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(name), np.int64)
    edges = np.searchsorted(which, np.arange((1 << bits) + 1))
    return [(kind, r, block, _packed(name[a:b], *(c[a:b] for c in columns)))
            for r, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]


_SEND = pa.schema([("kind", pa.int32()), ("range", pa.int64()), ("block", pa.int64()), ("names", pa.binary())])
_ROW = "kind int, range long, block long, names binary"
SAMPLE, SEVERAL, STRETCH, STRING = range(4)


def _answered(key, table):
    """One bit per name of each block: what the other blocks say about it."""
    kind = key[0].as_py()
    wide = {SAMPLE: (), SEVERAL: ("<u8", "<u8"), STRETCH: ("<u4", "<i8")}[kind]
    got = [_unpacked(raw, *wide) for raw in table.column("names").to_pylist()]
    sizes = np.array([len(g[0]) for g in got])
    columns = [np.concatenate(c) for c in zip(*got)]
    if kind == SAMPLE:
        _, of, count = np.unique(columns[0], return_inverse=True, return_counts=True)
        yes = count[of] > 1
    elif kind == SEVERAL:
        first, of = np.unique(columns[0], return_inverse=True)
        low, high = np.full(len(first), 2**64 - 1, np.uint64), np.zeros(len(first), np.uint64)
        np.minimum.at(low, of, columns[1])
        np.maximum.at(high, of, columns[2])
        yes = (low < high)[of]
    else:
        name, check, doc = columns
        order = np.lexsort((doc, check, name))
        new = np.concatenate([[True], (name[order][1:] != name[order][:-1]) | (check[order][1:] != check[order][:-1])])
        least = np.empty(len(name), np.int64)
        least[order] = doc[order][np.flatnonzero(new)][new.cumsum() - 1]
        yes = least < doc
    bits = [np.packbits(y).tobytes() for y in np.split(yes, sizes.cumsum()[:-1])]
    return pa.Table.from_arrays([table.column("kind"), table.column("range"), table.column("block"),
                                 pa.array(bits, pa.binary())], schema=_SEND)


def _bits(answers: pa.Table, kind: int, name: np.ndarray, bits: int) -> np.ndarray:
    """The answers to a block's sorted names, put together from their ranges."""
    which = (name >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(name), np.int64)
    edges = np.searchsorted(which, np.arange((1 << bits) + 1))
    out = np.zeros(len(name), bool)
    for k, r, raw in zip(answers.column("kind").to_pylist(), answers.column("range").to_pylist(),
                         answers.column("names").to_pylist()):
        if k == kind:
            a, b = edges[r], edges[r + 1]
            out[a:b] = np.unpackbits(np.frombuffer(raw, np.uint8), count=b - a)
    return out


def _marked(key, table):
    """Numbers of a block's strings that stand in earlier documents, as bits."""
    nth = table.column("nth").to_numpy()
    bits = np.zeros(int(nth.max()) + 1, bool)
    bits[nth] = True
    return pa.Table.from_arrays([pa.array([c], f.type) for c, f in
                                 zip((STRING, 0, key[0].as_py(), np.packbits(bits).tobytes()), _SEND)], schema=_SEND)


def _string_bits(answers: pa.Table, n: int) -> np.ndarray:
    out = np.zeros(n, bool)
    for k, raw in zip(answers.column("kind").to_pylist(), answers.column("names").to_pylist()):
        if k == STRING:
            bits = np.unpackbits(np.frombuffer(raw, np.uint8))[:n].astype(bool)
            out[:len(bits)] = bits
    return out


def _least(doc: np.ndarray, *keys: np.ndarray):
    """Distinct keys in order, the least document of each, and where each row is."""
    order = np.lexsort((doc, *keys[::-1]))
    d, sorted_ = doc[order], [k[order] for k in keys]
    new = np.ones(len(d), bool)
    if len(d):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_])
    of = np.empty(len(d), np.int64)
    of[order] = new.cumsum() - 1
    return [k[new] for k in sorted_], d[new], of


class _Rounds:
    """What a block knows after each round's answers."""

    def __init__(self, docs: pa.Table, answers: pa.Table | None, bits: int, upto: int):
        self.bits, self.answers = bits, answers
        self.id = docs.column("block")[0].as_py() if docs.num_rows else -1
        order = docs.column("ord").to_numpy()
        self.block = b = Block([t or b"" for t in docs.column("body").to_pylist()], order, upto >= STRETCH)
        if upto < STRETCH:
            return
        live_sample = _bits(answers, SAMPLE, b.samples, bits) | b.shared_here
        self.run = np.flatnonzero(live_sample[b.sample_of])
        self.doc = order[b.doc[self.run]]
        self.live, self.of_live = np.unique(b.sample[self.run], return_inverse=True)
        self.low, self.high = np.full(len(self.live), 2**64 - 1, np.uint64), np.zeros(len(self.live), np.uint64)
        np.minimum.at(self.low, self.of_live, b.stretch[self.run])
        np.maximum.at(self.high, self.of_live, b.stretch[self.run])
        (self.name, self.check), self.first, self.of = _least(self.doc, b.stretch[self.run], b.check[self.run])
        if upto < STRING:
            return
        earlier = _bits(answers, STRETCH, self.name, bits)
        self.whole = earlier[self.of] | (self.doc > self.first[self.of])
        several = _bits(answers, SEVERAL, self.live, bits)
        open_ = np.flatnonzero(~self.whole & several[self.of_live])
        run, self.start, *pair = b.strings(self.run[open_])
        self.string_doc = b.doc[run]
        self.pairs, self.s_first, self.s_of = _least(order[self.string_doc], *pair)

    def hits(self):
        """(document number, first start, last start) of repeated strings."""
        b = self.block
        earlier = _string_bits(self.answers, len(self.s_first))
        hit = earlier[self.s_of] | (b.order[self.string_doc] > self.s_first[self.s_of])
        runs = self.run[self.whole]
        return (np.concatenate([b.doc[runs], self.string_doc[hit]]),
                np.concatenate([b.lo[runs], self.start[hit]]), np.concatenate([b.hi[runs], self.start[hit]]))


def _ask(bits: int, upto: int):
    def run(_, docs, answers):
        rows = []
        if docs.num_rows:
            r = _Rounds(docs, answers, bits, upto)
            if upto == SAMPLE:
                rows = _requests(SAMPLE, r.id, bits, r.block.samples)
            else:
                rows = _requests(SEVERAL, r.id, bits, r.live, r.low, r.high) + \
                    _requests(STRETCH, r.id, bits, r.name, r.check, r.first)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SEND)], schema=_SEND) \
            if rows else _SEND.empty_table()
    return run


_PAIR = pa.schema([("block", pa.int64()), ("nth", pa.int32()), ("a", pa.int64()), ("b", pa.int64()),
                   ("tail", pa.int32()), ("doc", pa.int64())])


def _pairs(bits: int):
    """A block's open strings: number, rank pair, check, least document here."""
    def run(_, docs, answers):
        if not docs.num_rows:
            return _PAIR.empty_table()
        r = _Rounds(docs, answers, bits, STRING)
        (a, b, check), n = r.pairs, len(r.s_first)
        columns = [np.full(n, r.id), np.arange(n, dtype=np.int32), a.view(np.int64), b.view(np.int64),
                   check.view(np.int32), r.s_first]
        return pa.Table.from_arrays([pa.array(c) for c in columns], schema=_PAIR)
    return run


def _spans(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Per document number: maximal removed byte spans."""
    out: dict[int, list] = {}
    order = np.lexsort((lo, doc))
    for d, a, z in zip(doc[order].tolist(), lo[order].tolist(), (hi[order] + LENGTH).tolist()):
        spans = out.setdefault(d, [])
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], z)
        else:
            spans.append([a, z])
    return out


def _kept(text: bytes, spans) -> bytes:
    parts, at = [], 0
    for a, z in spans:
        parts.append(text[at:a])
        at = z
    return b"".join([*parts, text[at:]])


def _finish(bits: int, schema: pa.Schema):
    def run(_, docs, answers):
        if not docs.num_rows:
            return schema.empty_table()
        r = _Rounds(docs, answers, bits, STRING)
        spans = _spans(*r.hits())
        rows = [(t, spans.get(d, [])) for d, t in enumerate(r.block.texts)]
        kept = [_kept(t, s) for t, s in rows]
        columns = [docs.column("id").combine_chunks(), pa.array([len(t) for t, _ in rows], pa.int64()),
                   pa.array([len(t) - len(k) for (t, _), k in zip(rows, kept)], pa.int64()),
                   pa.array([len(s) for _, s in rows], pa.int64()),
                   pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
        if "spans" in schema.names:
            columns.append(pa.array([[{"start": a, "end": z} for a, z in s] for _, s in rows],
                                    schema.field("spans").type))
        return pa.Table.from_arrays(columns, schema=schema)
    return run


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   with_spans: bool = False, block_bytes: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_bytes, n_removed, n_spans,
    kept_sha256`` and, on request, the removed byte ``spans``.

    A byte is removed if a 50-byte string over it also starts in a document
    with a smaller id (integers). Null texts are empty. Rows with a null id
    come after all others and are not sources for one another; rows that repeat
    an id are not sources for one another either. Other columns are not read;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    rows = docs.select(F.col(id_col).alias("id"), order.alias("ord"),
                       F.coalesce(text_col, F.lit("")).cast("binary").alias("body"),
                       (F.monotonically_increasing_id()).alias("block"))
    kind = rows.schema["id"].dataType

    def blocked(it):
        """Cut each partition into blocks of bounded text; a block's number is its first row's."""
        number, size = None, 0
        for b in it:
            lengths = np.array([len(t) for t in b.column("body").to_pylist()])
            ids, out = b.column("block").to_numpy(), np.empty(b.num_rows, np.int64)
            for k, n in enumerate(lengths):
                if number is None or size + n > block_bytes:
                    number, size = ids[k], 0
                size += n
                out[k] = number
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out)], names=b.schema.names)

    # Written once, bucketed by block without moving a row: the rounds read it in place.
    name = f"repeats_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.mapInArrow(blocked, rows.schema).write.bucketBy(buckets, "block").format("parquet") \
        .option("path", f"{shared_folder(spark)}/{name}").option("compression", "zstd").saveAsTable(name)
    blocks = spark.table(name)
    total = blocks.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    bits = int(np.ceil(np.log2(max(1, total / 16 / _PER_RANGE))))
    answers = spark.createDataFrame([], _ROW)
    for upto in (SAMPLE, STRETCH):
        asked = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_ask(bits, upto), _ROW)
        answers = answers.unionByName(save(asked.groupBy("kind", "range").applyInArrow(_answered, _ROW), "answers"))
    pairs = blocks.groupBy("block").cogroup(answers.groupBy("block")) \
        .applyInArrow(_pairs(bits), "block long, nth int, a long, b long, tail int, doc long")
    # A pair has a row per block at most, so no key gathers more than the blocks.
    same = Window.partitionBy("a", "b", "tail")
    later = pairs.withColumn("least", F.min("doc").over(same)).where("least < doc").select("block", "nth")
    answers = answers.unionByName(save(later.groupBy("block").applyInArrow(_marked, _ROW), "answers"))
    fields = [("id", kind), ("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()),
              ("kept_sha256", T.StringType())]
    if with_spans:
        fields.append(("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                          T.StructField("end", T.LongType())]))))
    out = T.StructType([T.StructField(n, t) for n, t in fields])
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in out])
    return blocks.groupBy("block").cogroup(answers.groupBy("block")) \
        .applyInArrow(_finish(bits, arrow), out).withColumnRenamed("id", id_col)
