"""Benchmark decontamination with one FM-index per training shard.

A task gathers documents into shards, builds an FM-index (suffix ranks, BWT,
wavelet matrix, sampled suffix positions) over each shard's word sequence,
runs a backward search of all benchmark windows, locates their occurrences and
merges them into removal spans of words.

Only runs of benchmark words at least as long as the shortest window enter an
index: no occurrence can lie outside them, so the index stays small and exact.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import save, spare, words

WINDOW = 10
SHARD_SYMBOLS = 1 << 20     # indexed words after which a shard is closed
SHARD_BYTES = 32 << 20      # or this much text
BLOCK_WORDS = 400_000       # benchmark words searched (and broadcast) at a time
_SAMPLE = 8                 # every so many text positions keep their place
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class WaveletMatrix:
    """Rank queries ``rank(c, i)``: how often ``c`` is in the first ``i`` symbols."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.levels = []
        for bit in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            ones = (seq >> bit) & 1
            before = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(ones, out=before[1:])
            self.levels.append((bit, before, len(seq) - int(before[-1])))
            seq = np.concatenate([seq[ones == 0], seq[ones == 1]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        start = np.zeros_like(i)
        for bit, before, zeros in self.levels:
            one = ((c >> bit) & 1).astype(bool)
            i = np.where(one, zeros + before[i], i - before[i])
            start = np.where(one, zeros + before[start], start - before[start])
        return i - start


def suffix_ranks(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; ``text`` holds unique separators."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        second = np.zeros(n, np.int64)
        second[:max(0, n - k)] = rank[k:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        step = np.concatenate([[0], (np.diff(key[order]) != 0).cumsum()])
        rank = np.empty(n, np.int64)
        rank[order] = step
        if step[-1] == n - 1:
            return order
        k *= 2


class FMIndex:
    """Index of word runs; ``runs`` are arrays of symbols from 1 up."""

    def __init__(self, runs: list[np.ndarray]):
        lengths = np.array([len(r) + 1 for r in runs])
        text = np.zeros(lengths.sum(), np.int64)
        ends = lengths.cumsum() - 1
        inside = np.ones(len(text), bool)
        inside[ends] = False
        flat = np.concatenate(runs)
        self.alphabet, codes = np.unique(flat, return_inverse=True)
        text[inside] = codes + 1                       # 0: a separator
        unique = text + len(runs)
        unique[ends] = np.arange(len(runs))
        sa = suffix_ranks(unique)
        self.bwt = text[sa - 1]
        sigma = len(self.alphabet) + 1
        self.less = np.concatenate([[0], np.bincount(text, minlength=sigma).cumsum()])
        self.tree = WaveletMatrix(self.bwt, sigma)
        starts = ends - lengths + 1
        keep = np.zeros(len(text), bool)               # by text position
        keep[::_SAMPLE] = True
        keep[starts] = True
        self.kept = keep[sa]                           # by row
        self.kept_before = np.concatenate([[0], self.kept.cumsum()])
        self.places = sa[self.kept]
        self.starts, self.size = starts, len(text)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals ``[lo, hi)`` of equally long patterns, last word first."""
        at = np.searchsorted(self.alphabet, patterns)
        known = (self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == patterns).all(axis=1)
        lo = np.zeros(len(patterns), np.int64)
        hi = np.where(known, self.size, 0)
        live = np.flatnonzero(known)
        for j in range(patterns.shape[1] - 1, -1, -1):
            c = at[live, j] + 1
            lo[live] = self.less[c] + self.tree.rank(c, lo[live])
            hi[live] = self.less[c] + self.tree.rank(c, hi[live])
            live = live[lo[live] < hi[live]]
        dead = np.ones(len(patterns), bool)
        dead[live] = False
        hi[dead] = lo[dead]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: step back to the next sampled position."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        todo = np.flatnonzero(~self.kept[rows])
        while len(todo):
            c = self.bwt[rows[todo]]
            rows[todo] = self.less[c] + self.tree.rank(c, rows[todo])
            steps[todo] += 1
            todo = todo[~self.kept[rows[todo]]]
        return self.places[self.kept_before[rows]] + steps


def windows_of(items: list[tuple[str, str | None]], window: int = WINDOW) -> dict:
    """Distinct windows of a block of items, grouped by length."""
    vocab: dict[bytes, int] = {}
    found: dict[tuple, set[int]] = {}
    for k, (_, text) in enumerate(items):
        ids = [vocab.setdefault(w, len(vocab) + 1) for w in words(text)]
        for i in range(max(1, len(ids) - window + 1) if ids else 0):
            found.setdefault(tuple(ids[i:i + window]), set()).add(k)
    groups: dict[int, list] = {}
    for pattern, of in found.items():
        groups.setdefault(len(pattern), []).append((pattern, sorted(of)))
    return {"vocab": vocab, "names": [str(i) for i, _ in items], "shortest": min(groups, default=0),
            "groups": [(n, np.array([p for p, _ in g], np.int64), [np.array(o) for _, o in g])
                       for n, g in sorted(groups.items())]}


def _runs(ids: np.ndarray, shortest: int):
    """(start, end) of the stretches of known words that can hold a window."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).view(np.int8), [0]])))
    return [(a, b) for a, b in zip(edge[::2], edge[1::2]) if b - a >= shortest]


def merge_spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Union of word spans per document as sorted (doc, start, end) arrays."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    shift = (doc - doc[0]) * (int(end.max()) + 1)       # documents never touch
    reach = np.maximum.accumulate(end + shift)
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] + shift[1:] > reach[:-1])])
    first = np.flatnonzero(new)
    return doc[first], start[first], np.maximum.reduceat(end, first)


def search_shard(docs: list[np.ndarray], block: dict):
    """Merged spans and item numbers per document of a shard of word ids."""
    runs, owner, begin = [], [], []
    for d, ids in enumerate(docs):
        for a, b in _runs(ids, block["shortest"]):
            runs.append(ids[a:b])
            owner.append(d)
            begin.append(a)
    spans: list[list] = [[] for _ in docs]
    items: list[set] = [set() for _ in docs]
    if not runs:
        return spans, items
    index = FMIndex(runs)
    owner, begin = np.array(owner), np.array(begin)
    hits = []
    for n, patterns, of in block["groups"]:
        lo, hi = index.search(patterns)
        count = hi - lo
        which = np.repeat(np.arange(len(patterns)), count)
        rows = np.arange(len(which)) - np.repeat(count.cumsum() - count, count) + np.repeat(lo, count)
        at = index.locate(rows)
        run = np.searchsorted(index.starts, at, side="right") - 1
        doc, word = owner[run], begin[run] + at - index.starts[run]
        hits.append((doc, word, word + n))
        for d, p in np.unique(np.stack([doc, which], axis=1), axis=0):
            items[d].update(of[p].tolist())
    for d, a, b in zip(*merge_spans(*(np.concatenate(x) for x in zip(*hits)))):
        spans[d].append((int(a), int(b)))
    return spans, items


def _union(a: list[tuple], b: list[tuple]) -> list[tuple]:
    out: list[list] = []
    for s, e in sorted([*a, *b]):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _scan(bc, text_at: int, schema: pa.Schema):
    """Batches with the three result columns last: add what this block finds."""
    def run(it):
        block = bc.value
        held, ids, size, text_size = [], [], 0, 0

        def close():
            spans, items = search_shard(ids, block)
            k = 0
            for b in held:
                old_spans = b.column(b.num_columns - 2).to_pylist()
                old_items = b.column(b.num_columns - 1).to_pylist()
                n = b.num_rows
                new = [[{"start": s, "end": e} for s, e in _union([(x["start"], x["end"]) for x in o], sp)]
                       for o, sp in zip(old_spans, spans[k:k + n])]
                names = [sorted({*o, *(block["names"][i] for i in it_)})
                         for o, it_ in zip(old_items, items[k:k + n])]
                count = pa.array([len(x) for x in ids[k:k + n]], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:-3], count, pa.array(new, _SPANS), pa.array(names, pa.list_(pa.string()))],
                    schema=schema)
                k += n

        get = block["vocab"].get
        for whole in it:
            for start in range(0, whole.num_rows, 200):
                b = whole.slice(start, 200)
                for t in b.column(text_at).to_pylist():
                    w = words(t)
                    x = np.fromiter(map(get, w, repeat(0)), np.int32, len(w))
                    ids.append(x)
                    text_size += len(t or "")
                    size += np.count_nonzero(x)
                held.append(b)
                if size > SHARD_SYMBOLS or text_size > SHARD_BYTES:
                    yield from close()
                    held, ids, size, text_size = [], [], 0, 0
        if held:
            yield from close()
    return run


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int):
    """Bounded blocks of items, streamed: the driver holds one at a time."""
    block, size = [], 0
    for r in benchmark.select(F.col(id_col).cast("string"), text_col).toLocalIterator():
        n = len(words(r[1]))
        if n:
            block.append((r[0], r[1]))
            size += n
        if size > limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every row of ``docs`` with ``n_words, spans, items`` appended.

    ``spans`` are merged word ranges [start, end) covered by a window of a
    benchmark item (10 consecutive words, or the whole item if shorter);
    ``items`` are the ids, as sorted strings, of items with such a window.
    Null and empty texts have no word; an item without words matches nothing;
    a null item id is listed as "None"; repeated rows are judged each on their
    own; an empty benchmark or table gives no spans or no rows. A column of
    ``docs`` named like a result column is replaced by it.
    """
    spark = docs.sparkSession
    out = docs.drop("n_words", "spans", "items").select(
        "*", F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in out.schema])
    text_at = out.columns.index(text_col)
    arrow = pa.schema([*list(to_arrow_schema(schema))[:-2], pa.field("spans", _SPANS),
                       pa.field("items", pa.list_(pa.string()))])
    first = True
    for block in _blocks(benchmark, item_col, item_text_col, block_words):
        if not first:
            out = save(out, "decontaminated")
        out = out.mapInArrow(_scan(spark.sparkContext.broadcast(windows_of(block)), text_at, arrow), schema)
        first = False
    if first:
        empty = windows_of([])
        out = out.mapInArrow(_scan(spark.sparkContext.broadcast(empty), text_at, arrow), schema)
    return out


def cut_words(text: str, spans) -> str:
    """``text`` without the characters from each span's first to last word."""
    raw = text.encode()
    lowered = raw.lower()        # bytes.lower touches A-Z only
    place = [m.span() for m in _WORD.finditer(lowered)]
    kept, at = [], 0
    for s in spans:
        a, b = (s["start"], s["end"]) if isinstance(s, dict) else s
        kept.append(raw[at:place[a][0]])
        at = place[b - 1][1]
    kept.append(raw[at:])
    return b"".join(kept).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with benchmark passages cut out of ``text_col``; same columns.

    Documents without a hit stay as they are (null and empty texts too); of
    others the characters from a span's first to its last word go, what stands
    before and after stays. Ids are not read; repeated rows are cut alike.
    """
    names, at = docs.columns, docs.columns.index(text_col)

    def cut(it):
        for b in it:
            texts = b.column(at).to_pylist()
            spans = b.column(b.num_columns - 1).to_pylist()
            new = [cut_words(t, s) if s else t for t, s in zip(texts, spans)]
            cols = [pa.array(new, b.schema.field(at).type) if i == at else c
                    for i, c in enumerate(b.columns[:-1])]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    own = docs
    for c in ("n_words", "spans", "items"):
        if c in own.columns:
            own = own.withColumnRenamed(c, spare(own, c))
    marked = contaminated_spans(own, benchmark, text_col).select(*own.columns, "spans")
    return marked.mapInArrow(cut, docs.schema)
