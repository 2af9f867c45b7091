"""Conversation repair against an exhaustive search over edit strings."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from conftest import SF_SMALL

from txrisk.llm import conversations as C
from txrisk.llm.queries import QUERIES

SCHEMA = "conv_id long, turn int, role string, text string, cost string"
LEGAL = re.compile(r"(s?(ua)+)?")


def _damage(rows):
    """(turn, role, text) rows of one conversation after damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        row = (turn, "user" if fate == 4 else role, text)
        out += [] if fate == 0 else [row, row] if fate == 3 else [row]
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def _facts(rows):
    seen, flags = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        flags.append("blank" if not solid else "duplicate" if (role, text) in seen else
                     "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return flags


def _search(rows, flags):
    """Cheapest, then least, audit by best-first search over whole prefixes."""
    start = (0, "", 0, ())       # cost, audit, rows used, (role, text) lines
    heap = [start]
    while heap:
        cost, audit, at, lines = heapq.heappop(heap)
        if at == len(rows) and LEGAL.fullmatch("".join(r[:1] for r, _ in lines)):
            return cost, audit, "\n".join(f"{r}:{t}" for r, t in lines)
        steps = [(5, "I", at, (role, "")) for role in ("user", "assistant")]
        if at < len(rows):
            _, role, text = rows[at]
            extra = 5 * (flags[at] == "truncated")
            steps.append((2, "D", at + 1, None))
            if flags[at] not in ("blank", "duplicate"):
                steps.append((extra, "K", at + 1, (role, text)))
                steps += [(1 + extra, "R", at + 1, (r, text)) for r in ("user", "assistant")]
        for c, letter, to, line in steps:
            new = lines + ((line,) if line else ())
            # Any legal sequence begins like this one, or the prefix is hopeless.
            if re.fullmatch(r"s?(ua)*u?", "".join(r[:1] if r else "?" for r, _ in new)):
                heapq.heappush(heap, (cost + c, audit + letter, to, new))
    raise AssertionError("no repair")


def _expected(rows):
    out = {}
    for conv, group in itertools.groupby(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), key=lambda r: r[0]):
        got = _damage([r[:4] for r in group])
        flags = _facts(got)
        turns = {r[0] for r in got if r[0] is not None}
        initials = [r[1][:1] for r in got]
        cost, audit, text = _search(got, flags)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(flags.count(f) for f in
                     ("blank", "duplicate", "truncated")),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


def _random_rows(n, seed, most=7):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", None, "", "u2"], ["Hi.", "No", " ", "", None, "So? ", "Yes!\n"]
    return [(conv, None if rng.random() < .1 else rng.randint(0, 6), rng.choice(roles[:3] * 3 + roles),
             rng.choice(texts) if rng.random() < .6 else f"T{rng.random()}.", "x")
            for conv in range(n) for _ in range(rng.randint(1, most))]


@pytest.mark.parametrize("kw", [{}, {"long_rows": 2}, {"long_rows": 3, "long_bytes": 20}, {"long_bytes": 0}])
def test_random_conversations(spark, kw):
    """Whole groups and segments of every size give the same, right results."""
    rows = _random_rows(150, 3) + [(None, t, "user", f"x{t}.", "") for t in range(6)]
    got = C.repair_conversations(spark.createDataFrame(rows, SCHEMA).repartition(5), **kw).collect()
    want = _expected(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], r


def test_long_conversation_in_segments(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"t{rng.randint(0, 400)}{rng.choice('..!x')}", "") for t in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    one = C.repair_conversations(df).collect()
    assert one == C.repair_conversations(df, long_rows=37).collect()
    edits = one[0].audit
    assert len(edits) - edits.count("I") == len(_damage([r[:4] for r in rows]))


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.repair_conversations(empty).count() == 0
    gone = [c for c in range(200) if zlib.crc32(f"{c}:1".encode()) % 20 == 0]
    assert gone
    rows = [(c, 1, "user", "a.", "") for c in gone] + [(10_000, None, None, None, None)] * 3 \
        + [(20_000, 5, "user", "é" * 100_000 + ".", "")]
    got = {r.conv_id: tuple(r)[1:] for r in C.repair_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == _expected(rows)
    assert got[gone[0]] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_query_against_search(spark):
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_conversations"](spark, SF_SMALL).collect()}
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    assert got == _expected(rows) and len(got) > 10


def _list(letters, before=None):
    node = before or C.Node(None, "")
    for x in letters:
        node = C.Node(node, x)
    return node


@pytest.mark.parametrize("mod", [C._MOD, 5, 1])
def test_order_of_edit_lists(monkeypatch, mod):
    """Least common prefix search equals string order, also when hashes collide."""
    monkeypatch.setattr(C, "_MOD", mod)
    rng = random.Random(mod)
    shared = _list("".join(rng.choice("DIKR") for _ in range(70)))
    lists = [_list("".join(rng.choice("DK") for _ in range(rng.randint(0, 9))), b) for b in (None, shared) for _ in range(60)]
    lists += [_list("K" * 40 + x) for x in ("", "D", "R", "KD")]
    for a, b in itertools.product(lists, repeat=2):
        assert C.less(a, b) == (a.letters() < b.letters())
    assert shared.ancestor(33).letters() == shared.letters()[:33]
