import random
import re

import numpy as np
import xxhash

from txrisk.llm import simhash as sh


def _brute_print(text):
    w = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    s = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def _brute_groups(rows):
    prints = [_brute_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    fp = np.array(prints, np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 2):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return sorted(((d, f"{p:016x}", low.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=repr)


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 1 << 23, 3000)
    row, index = sh.fuzzy_indices(v)
    assert set(np.bincount(row)) == {1, 6}
    keys = [set() for _ in v]
    for r, i in zip(row, index):
        keys[r].add(i)
    for flips in (0, 1, 2):
        u = v.copy()
        for _ in range(flips):
            u ^= 1 << rng.integers(0, 23, len(u))
        r2, i2 = sh.fuzzy_indices(u)
        other = [set() for _ in v]
        for r, i in zip(r2, i2):
            other[r].add(i)
        assert all(a & b for a, b in zip(keys, other))


def test_all_pairs_found(spark):
    rnd = random.Random(3)
    fps = {0, 1, 2**63, 2**64 - 1}
    for _ in range(150):
        x = rnd.getrandbits(64)
        fps.add(x)
        for _ in range(4):
            fps.add(x ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)))
            fps.add(x ^ (1 << rnd.randrange(64)))
    df = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in fps], "fp long")
    want = {(a, b) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= 2}
    for hot in (2048, 1):            # also with every key refined
        got = {(r.a % 2**64, r.b % 2**64) for r in sh.near_pairs(df, hot).collect()}
        assert got | {(b, a) for a, b in got} == want


ROWS = [(5, "a b c d e f"), (3, "A B  C d\te f"), (7, None), (9, ""), (2, "x"), (None, "x"), (None, "only here y z"),
        (None, "only here y z"), (2, "x"), (4, "ü É straße word " * 4000), (6, "one two"), (8, "nb sp ace"), (1, "\x1f")]


def test_groups_and_edges(spark):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in ROWS], "doc_id long, text string, fp string, row int")
    got = sorted([tuple(r) for r in sh.simhash_groups(df).collect()], key=repr)
    assert got == _brute_groups(ROWS)
    kept = sh.dedup(df)
    assert kept.columns == df.columns
    groups = {}
    for d, p, c in got:
        groups.setdefault(c if c is not None else p, []).append(d)
    assert sorted([r.doc_id for r in kept.collect()], key=repr) == \
        sorted([min((x for x in g if x is not None), default=None) for g in groups.values()], key=repr)
    assert sh.simhash_groups(df.limit(0)).count() == 0 == sh.dedup(df.limit(0)).count()


def test_query(spark):
    from txrisk.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted([tuple(r) for r in QUERIES["op3_simhash"](spark, sf).collect()], key=repr)
    want = _brute_groups(rows)
    assert got == want and any(d != c for d, _, c in want)
