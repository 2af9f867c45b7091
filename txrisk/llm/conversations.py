"""Conversation repair: cheapest edits that give a legal sequence of roles.

Rows are kept, given another role or deleted, empty turns are inserted, until
the role initials read ``(s?(ua)+)?``. Of all cheapest edit lists the one whose
initials (D, I, K, R) are the least string is the audit.

The search is a dynamic programme over the rows with one best (cost, edits) per
state of that pattern. Edit lists are never copied: they share their prefixes
as linked nodes, each with its length, a rolling hash and pointers to its
ancestors at powers of two. Of two lists of equal cost the least is found by a
search for their longest common prefix, which compares the hashes of ancestors;
where two different nodes have the same hash, the letters are compared.

A conversation of bounded size is one group of one task. A longer one is cut
into segments in row order. Each is reduced by itself, from every state to every
state; the programme over segments then compares ranks instead of letters: all
lists of a segment hold its rows' letters and end in one, so none is a prefix
of another, and lists compare segment by segment.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import save

LONG_ROWS = 4096            # rows of a conversation, or of a segment, that one task holds at most
LONG_BYTES = 32 << 20       # or bytes of their texts (a single row may be longer)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# States of (s?(ua)+)?: 0 nothing yet, 1 after s, 2 after u, 3 after a. Legal ends: 0 and 3.
STATES, ENDS = 4, (0, 3)
_NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_ROLES = {"u": "user", "a": "assistant"}
_SPACES = " \t\n\x0b\x0c\r"
_MOD, _BASE = (1 << 61) - 1, 1_000_003


# ---------------------------------------------------------------- edit lists
class Node:
    """The end of an edit list; ``up[j]`` is the node 2^j letters before it."""

    __slots__ = ("letter", "size", "hash", "up")

    def __init__(self, before: "Node | None", letter):
        self.letter = letter
        if before is None:
            self.size, self.hash, self.up = 0, 0, ()
            return
        self.size = before.size + 1
        self.hash = (before.hash * _BASE + hash(letter) + 1) % _MOD
        up, j, at = [before], 0, before
        while j < len(at.up):
            at = at.up[j]
            up.append(at)
            j += 1
        self.up = tuple(up)

    def ancestor(self, size: int) -> "Node":
        at = self
        while at.size > size:
            at = at.up[(at.size - size).bit_length() - 1]
        return at

    def letters(self) -> list:
        out, at = [], self
        while at.size:
            out.append(at.letter)
            at = at.up[0]
        return out[::-1]


def _verified(a: Node, b: Node) -> bool:
    """Whether lists of equal length and hash are equal, letter by letter."""
    while a is not b and a.size:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(a: Node, b: Node) -> bool:
    """Whether a's letters come before b's: by their longest common prefix."""
    if a is b:
        return False
    size = min(a.size, b.size)
    x, y = a.ancestor(size), b.ancestor(size)
    if x is y or x.hash == y.hash and _verified(x, y):
        return a.size < b.size
    p, q = x, y
    for j in range(len(x.up) - 1, -1, -1):
        # Ancestors that differ in their hash differ; move both up to them.
        if j < len(p.up) and p.up[j] is not q.up[j] and p.up[j].hash != q.up[j].hash:
            p, q = p.up[j], q.up[j]
    before, other = (p.up[0], q.up[0]) if p.size else (p, q)
    if p.letter != q.letter and (before is other or _verified(before, other)):
        return p.letter < q.letter
    return x.letters() < y.letters()        # a collision of hashes: compare as they are


def _better(one, two) -> bool:
    """(cost, node) pairs; None is no way at all."""
    return one is not None and (two is None or one[0] < two[0] or one[0] == two[0] and one is not two
                                and less(one[1], two[1]))


def _inserted(best: list) -> list:
    """Best ways into every state when turns may also be inserted."""
    best = best.copy()
    for _ in range(STATES - 1):
        moved = False
        for nexts in (_NEXT["u"], _NEXT["a"]):
            for a, b in nexts.items():
                if best[a] is not None and (best[b] is None or best[a][0] + INSERT <= best[b][0]):
                    way = best[a][0] + INSERT, Node(best[a][1], "I")
                    if _better(way, best[b]):
                        best[b], moved = way, True
        if not moved:
            break
    return best


def advance(best: list, initial: str, gone: bool, truncated: bool) -> list:
    """Best (cost, node) per state after one more row."""
    best = _inserted(best)
    out: list = [None] * STATES

    def offer(state, cost, before, letter):
        old = out[state]
        if old is None or cost <= old[0]:
            way = cost, Node(before, letter)
            if _better(way, old):
                out[state] = way

    extra = TRUNCATED * truncated
    for state, way in enumerate(best):
        if way is None:
            continue
        offer(state, way[0] + DELETE, way[1], "D")
        if gone:
            continue
        kept = _NEXT.get(initial, {}).get(state)
        if kept is not None:
            offer(kept, way[0] + KEEP + extra, way[1], "K")
        for role in "ua":
            to = _NEXT[role].get(state)
            if to is not None and to != kept:
                offer(to, way[0] + REROLE + extra, way[1], "R")
    return out


def _ended(best: list):
    best = _inserted(best)
    one, two = (best[s] for s in ENDS)
    return one if _better(one, two) else two


def repaired(audit: str, rows, state: int = 0):
    """``role:text`` lines that the edits leave of (role, text) rows, and the state after."""
    rows = iter(rows)
    for k, letter in enumerate(audit):
        if letter == "I":
            role, text = ("a" if state == 2 else "u"), ""
            name = _ROLES[role]
        else:
            name, text = next(rows)
            if letter == "D":
                continue
            role = name[:1] if letter == "K" else "a" if state == 2 else "u"
            name = name if letter == "K" else _ROLES[role]
        state = _NEXT[role][state]
        yield f"{name}:{text}"


# ------------------------------------------------------------------ the rows
def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """``conv, turn, role, text, dropped`` after damage by crc32(``conv:turn``) % 20:
    0 drops the row (it is marked), 1 empties the text, 2 takes its ``.!?`` out,
    3 repeats the row, 4 makes it a user's. A null in key, role or text is one space."""
    def spaced(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    key = F.concat(spaced(conv_col), F.lit(":"), spaced(turn_col))
    fate = F.crc32(key.cast("binary")) % 20
    rows = conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                                spaced(role_col).alias("role"), spaced(text_col).alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 0, "").when(F.col("fate") == 1, "") \
        .when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    copies = F.sequence(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1))
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), (F.col("fate") == 0).alias("dropped"),
                       F.explode(copies).alias("copy")).drop("copy")


def _faults(text: Column) -> tuple[Column, Column]:
    """Blank, and cut off: the last character that is no space is none of ``.!?``."""
    solid = F.rtrim(text, F.lit(_SPACES))
    return F.octet_length(solid) == 0, ~F.substring(solid, -1, 1).isin(*".!?")


_ORDER = ["turn", "role", "text"]        # ascending: nulls first
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_LEGAL = ("su", "ua", "au")


def _schema(conv: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("conv", conv), *(T.StructField(c, T.LongType()) for c in _COUNTS),
                         T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])


def _repair_group(conv, rows) -> tuple:
    """One result row of a conversation's (turn, role, text, blank, cut) rows in order."""
    best = [(0, Node(None, ""))] + [None] * (STATES - 1)
    seen, counts = set(), [0, 0, 0]
    for _, role, text, blank, cut in rows:
        repeated = (role, text) in seen
        seen.add((role, text))
        fault = 0 if blank else 1 if repeated else 2 if cut else None
        if fault is not None:
            counts[fault] += 1
        best = advance(best, role[:1], blank or repeated, fault == 2)
    cost, node = _ended(best)
    audit = "".join(node.letters())
    known = {r[0] for r in rows if r[0] is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
    out = hashlib.sha256("\n".join(repaired(audit, (r[1:3] for r in rows))).encode()).hexdigest()
    return conv, gaps, *counts, illegal, cost, audit, out


def _repair_sorted(schema: pa.Schema):
    """Stream sorted rows; one conversation of bounded size is held at a time."""
    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    def run(it):
        open_, held, out = None, None, []
        for batch in it:
            for at in range(0, batch.num_rows, 2000):
                for conv, dropped, *row in zip(*(c.to_pylist() for c in batch.slice(at, 2000).columns)):
                    if held is None or conv != open_:
                        if held is not None:
                            out.append(_repair_group(open_, held))
                        open_, held = conv, []
                    if not dropped:
                        held.append(row)
                if out:
                    yield batch_of(out)
                    out = []
        if held is not None:
            yield batch_of([_repair_group(open_, held)])
    return run


# ------------------------------------------------------- long conversations
def _cut_segments(rows_limit: int, bytes_limit: int, names: list[str]):
    """Number the rows of a sorted partition by segment (``seg``, of one
    conversation, rising in its order) and place in it (``at``)."""
    def run(it):
        part, open_, seg, at, size = TaskContext.get().partitionId(), None, -1, 0, 0
        for batch in it:
            segs, ats = [], []
            sizes = batch.column(names.index("size")).to_pylist()
            for conv, n in zip(batch.column(0).to_pylist(), sizes):
                if seg < 0 or conv != open_ or at >= rows_limit or size + n > bytes_limit:
                    open_, seg, at, size = conv, seg + 1, 0, 0
                segs.append((part << 32) + seg)
                ats.append(at)
                at, size = at + 1, size + n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segs, pa.int64()), pa.array(ats, pa.int64())],
                                             names=[*names, "seg", "at"])
    return run


def reduce_segment(rows) -> list[tuple[int, int, int, str]]:
    """(from state, to state, cost, edits) of every best way through a
    segment's (initial, gone, truncated) rows, last edit a row's."""
    out = []
    for start in range(STATES):
        best: list = [None] * STATES
        best[start] = (0, Node(None, ""))
        for row in rows:
            best = advance(best, *row)
        out += [(start, end, w[0], "".join(w[1].letters())) for end, w in enumerate(best) if w is not None]
    return out


def _segment_ways(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("at")
    ways = reduce_segment(list(zip(pdf["initial"], pdf["blank"] | pdf["repeated"], pdf["cut"] & ~pdf["repeated"])))
    rank = {s: k for k, s in enumerate(sorted({w[3] for w in ways}))}
    initials = pdf["initial"].tolist()
    return pd.DataFrame({
        "conv": [pdf["conv"].iloc[0]] * len(ways), "seg": pdf["seg"].iloc[0], "start": [w[0] for w in ways],
        "end": [w[1] for w in ways], "cost": [w[2] for w in ways], "rank": [rank[w[3]] for w in ways],
        "edits": [w[3] for w in ways], "first": initials[0], "last": initials[-1],
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))})


def _join_segments(pdf: pd.DataFrame) -> pd.DataFrame:
    """The best way through a conversation's segments: one row per segment."""
    best = [(0, Node(None, ()))] + [None] * (STATES - 1)
    illegal, last = 0, None
    for _, group in pdf.groupby("seg", sort=True):
        head = group.iloc[0]
        illegal += int(head["illegal"]) + (last is not None and last + head["first"] not in _LEGAL)
        last = head["last"]
        out: list = [None] * STATES
        for r in group.itertuples():
            if best[r.start] is not None:
                # The rank comes first in a letter; equal edits from one state end in one state.
                way = best[r.start][0] + int(r.cost), Node(best[r.start][1], (int(r.rank), int(r.start), int(r.end)))
                if _better(way, out[r.end]):
                    out[r.end] = way
        best = out
    won, turns = None, 0
    for end, n in ((0, 0), (3, 0), (2, 1), (1, 2)):     # turns that must still be inserted
        way = best[end] and (best[end][0] + INSERT * n, best[end][1])
        if way is not None and _better(way, won):
            won, turns = way, n
    letters, segs = won[1].letters(), sorted(pdf["seg"].unique())
    return pd.DataFrame({"conv": [pdf["conv"].iloc[0]] * len(segs), "seg": segs, "start": [x[1] for x in letters],
                         "end": [x[2] for x in letters], "turns": [0] * (len(segs) - 1) + [turns],
                         "illegal": illegal, "cost": won[0]})


def _segment_lines(rows: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
    """What the chosen edits leave of a segment."""
    way, rows = chosen.iloc[0], rows.sort_values("at")
    edits = way["edits"] + "I" * int(way["turns"])
    lines = list(repaired(edits, zip(rows["role"], rows["text"]), int(way["start"])))
    return pd.DataFrame({"conv": [way["conv"]], "seg": [way["seg"]], "edits": [edits], "lines": [len(lines)],
                         "left": ["\n".join(lines)]})


def _digests(schema: pa.Schema):
    """Stream sorted segments: audit and digest of each conversation."""
    def run(it):
        open_, digest, audit, any_ = None, None, [], False
        for batch in it:
            for conv, edits, lines, left in zip(*(c.to_pylist() for c in batch.columns)):
                if digest is None or conv != open_:
                    if digest is not None:
                        yield one(open_, audit, digest)
                    open_, digest, audit, any_ = conv, hashlib.sha256(), [], False
                audit.append(edits)
                if lines:
                    digest.update((("\n" if any_ else "") + left).encode())
                    any_ = True
        if digest is not None:
            yield one(open_, audit, digest)

    def one(conv, audit, digest):
        values = conv, "".join(audit), digest.hexdigest()
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)
    return run


def _repair_long(rows: DataFrame, conv_type: T.DataType, rows_limit: int, bytes_limit: int) -> DataFrame:
    """Results of conversations too long for one group."""
    conv = conv_type.simpleString()
    order = ["conv", *_ORDER, "uid"]      # uid deals out rows that are equal
    numbered = rows.withColumn("uid", F.monotonically_increasing_id()).repartitionByRange(*order) \
        .sortWithinPartitions(*order).drop("uid")
    typed = T.StructType([*numbered.schema.fields, T.StructField("seg", T.LongType()), T.StructField("at", T.LongType())])
    numbered = save(numbered.mapInArrow(_cut_segments(rows_limit, bytes_limit, numbered.columns), typed), "conv-segments")
    # The first of equal (role, text) rows is no duplicate.
    text = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    first = numbered.groupBy("conv", text.alias("digest")).agg(F.min(F.struct("seg", "at")).alias("p")) \
        .select("p.seg", "p.at", F.lit(False).alias("repeated"))
    flagged = save(numbered.drop("text", "size").withColumn("initial", F.substring("role", 1, 1)).drop("role")
                   .join(first, ["seg", "at"], "left").withColumn("repeated", F.coalesce("repeated", F.lit(True))),
                   "conv-flags")
    ways = save(flagged.groupBy("seg").applyInPandas(
        _segment_ways, f"conv {conv}, seg long, start int, end int, cost long, rank int, edits string, first string, "
                       "last string, illegal long"), "conv-ways")
    joined = save(ways.drop("edits").groupBy("conv").applyInPandas(
        _join_segments, f"conv {conv}, seg long, start int, end int, turns int, illegal long, cost long"), "conv-joined")
    chosen = joined.drop("illegal", "cost").join(ways.select("seg", "start", "end", "edits"), ["seg", "start", "end"])
    lines = numbered.select("seg", "at", "role", "text").groupBy("seg").cogroup(chosen.groupBy("seg")).applyInPandas(
        _segment_lines, f"conv {conv}, seg long, edits string, lines long, left string")
    out = T.StructType([T.StructField("conv", conv_type), T.StructField("audit", T.StringType()),
                        T.StructField("repaired_sha256", T.StringType())])
    texts = lines.repartition("conv").sortWithinPartitions("conv", "seg").select("conv", "edits", "lines", "left") \
        .mapInArrow(_digests(pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out])), out)
    fine = F.col("blank") | F.col("repeated")
    counts = flagged.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        F.count_if("blank").alias("blank"), F.count_if(~F.col("blank") & F.col("repeated")).alias("duplicate"),
        F.count_if(F.col("cut") & ~fine).alias("truncated"))
    totals = joined.groupBy("conv").agg(F.max("illegal").alias("illegal"), F.max("cost").alias("cost"))
    both = counts.join(totals.withColumnRenamed("conv", "c"), F.expr("conv <=> c")).drop("c")
    return both.join(texts.withColumnRenamed("conv", "c"), F.expr("conv <=> c")).drop("c")


def repair_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", long_rows: int = LONG_ROWS,
                         long_bytes: int = LONG_BYTES) -> DataFrame:
    """Damage ``conversations`` (see ``damaged``), then repair them: per
    conversation ``conv_col, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256``.

    Rows are taken by turn (nulls first), those of one turn by role, then text.
    A null ``conv_col`` is a conversation of its own; repeated rows are
    duplicates; roles other than user, assistant and system can't be kept
    (roles count by their first letter); blank rows and copies are deleted. A
    conversation without rows after the damage has zeros, an empty audit and the
    digest of nothing. No other column is read; an empty table gives an empty
    result. Conversations of more than ``long_rows`` rows or ``long_bytes``
    bytes are worked on in segments of that size, with the same results.
    """
    conv_type = conversations.schema[conv_col].dataType
    blank, cut = _faults(F.col("text"))
    rows = damaged(conversations, conv_col, turn_col, role_col, text_col) \
        .withColumn("blank", blank).withColumn("cut", cut)
    size = F.octet_length("role") + F.octet_length("text")
    live = ~F.col("dropped")
    long_ = rows.where(live).groupBy("conv").agg(F.count("*").alias("n"), F.sum(size.cast("long")).alias("b")) \
        .where((F.col("n") > long_rows) | (F.col("b") > long_bytes)).select(F.col("conv").alias("c"))
    long_ = save(long_, "conv-long")
    any_long = not long_.isEmpty()
    short = rows.join(long_, F.expr("conv <=> c"), "left_anti") if any_long else rows
    schema = _schema(conv_type)
    result = short.select("conv", "dropped", "turn", "role", "text", "blank", "cut").repartition("conv") \
        .sortWithinPartitions("conv", *_ORDER) \
        .mapInArrow(_repair_sorted(pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])), schema)
    if any_long:
        apart = rows.where(live).withColumn("size", size.cast("long")).drop("dropped") \
            .join(long_, F.expr("conv <=> c"), "left_semi")
        result = result.unionByName(_repair_long(apart, conv_type, long_rows, long_bytes))
    return result.withColumnRenamed("conv", conv_col)
