import hashlib
import random

import pytest

from txrisk.llm import repeats as rp


def _brute(rows):
    """Every 50-byte string against the least id it starts in."""
    least = {}
    body = [(float("inf") if d is None else d, (t or "").encode()) for d, t in rows]
    for d, t in body:
        for i in range(len(t) - 49):
            s = t[i:i + 50]
            least[s] = min(least.get(s, d), d)
    out = []
    for (d, _), (o, t) in zip(rows, body):
        gone = bytearray(len(t))
        for i in range(len(t) - 49):
            if least[t[i:i + 50]] < o:
                gone[i:i + 50] = b"\x01" * 50
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def _random_rows(seed):
    rnd = random.Random(seed)
    words = ["the", "of", "ção", "inea", "ß", "er", "a", "tion", "x" * 12, "\n", "🙂"]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(5, 250))) for _ in range(25)]
    rows = []
    for d in range(120):
        t = rnd.choice(base)
        kind = rnd.randrange(6)
        if kind == 1:
            a = rnd.randrange(len(t))
            t = t[:a] + rnd.choice(words) + t[a + rnd.randrange(4):]
        elif kind == 2:
            u = rnd.choice(base)
            a, b = rnd.randrange(len(t)), rnd.randrange(len(u))
            t = t[:a] + u[b:b + rnd.randrange(40, 120)] + t[a:]
        elif kind == 3:
            t = " ".join(rnd.choice(words) for _ in range(60))
        elif kind == 4:
            t = t[rnd.randrange(10):][:rnd.randrange(40, 70)]
        rows.append((d, t))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block", [1 << 23, 700])
def test_against_every_string(spark, seed, block):
    rows = _random_rows(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert _rows(rp.repeated_bytes(df, block_bytes=block)) == _brute(rows)


def test_edges(spark, monkeypatch):
    t = "abcdefghij" * 5
    rows = [(3, t), (1, None), (2, ""), (None, t), (None, t + "!"), (4, t[:49]), (5, "x" + t), (5, "x" + t), (7, "z" * 3000),
            (6, "z" * 60), (8, "ab" * 20_000), (9, "ba" * 20_000), (0, "y" * 50)]
    df = spark.createDataFrame([(d, x, "c", 1, 2) for d, x in rows], "doc_id long, text string, id string, block int, ord int")
    assert _rows(rp.repeated_bytes(df)) == _brute(rows)
    assert rp.repeated_bytes(df.limit(0)).count() == 0
    spans = {r.doc_id: r.spans for r in rp.repeated_bytes(df.where("doc_id in (3, 5)"), with_spans=True).collect()}
    assert spans[3] == [] and [tuple(s) for s in spans[5]] == [(1, 51)]


def test_long_texts_are_sliced(monkeypatch):
    monkeypatch.setattr(rp, "_SLICE", 300)
    rnd = random.Random(4)
    long = "".join(rnd.choice("abcd") for _ in range(5000)).encode()
    b = rp.Block([long, long[100:2000]], rp.np.array([1, 2]))
    seen = [sorted((lo, hi) for d, lo, hi in zip(b.doc, b.lo, b.hi) if d == k) for k in (0, 1)]
    for runs, n in zip(seen, (5000, 1900)):
        assert [i for lo, hi in runs for i in range(lo, hi + 1)] == list(range(n - 49))


def test_query(spark):
    from txrisk.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op4_repeats"](spark, sf)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = _brute(rows)
    assert _rows(got) == want and any(r[2] for r in want)
