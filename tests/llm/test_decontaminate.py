import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from txrisk.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def _brute(docs, items):
    """{index: (n_words, n_hit, sorted item ids)} by trying every position."""
    wins = {}
    for i, t in items:
        w = _words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            wins.setdefault(tuple(w[k:k + 10]), set()).add(str(i))
    sizes = sorted({len(x) for x in wins})
    out = []
    for t in docs:
        w, hit, of = _words(t), set(), set()
        for k in range(len(w)):
            for n in sizes:
                got = wins.get(tuple(w[k:k + n])) if k + n <= len(w) else None
                if got:
                    hit.update(range(k, k + n))
                    of |= got
        out.append((len(w), len(hit), sorted(of)))
    return out


def _digest(spans, items):
    return sum(s.end - s.start for s in spans), list(items)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short ITEM"), (10, "x"),
         (3, "two three four five six seven eight nine ten eleven"), (4, None), (5, "..."), (6, "é è ñ")]
DOCS = [None, "", "x", "no words here at all", "pre one two three four five six seven eight nine ten post",
        "ONE, two; three.four five six seven eight nine ten eleven twelve and short item",
        "one two three four five six seven eight nine", "short item " * 3000, "é è ñ é è ñ", "short\x00item",
        "eight nine ten one two three four five six seven eight nine ten eleven twelve two three four five six seven "
        "eight nine ten eleven", "short item", "short item"]


@pytest.mark.parametrize("block_words", [10**6, 5])
def test_brute_force(spark, block_words):
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(DOCS)], "doc_id long, text string, spans string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = dc.contaminated_spans(docs, bench, block_words=block_words).collect()
    want = _brute(DOCS, ITEMS)
    assert {r.doc_id: (r.n_words, *_digest(r.spans, r.items)) for r in rows} == dict(enumerate(want))


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.spans for r in dc.contaminated_spans(docs, none).collect()] == [[], []]
    assert dc.contaminated_spans(docs.limit(0), none).count() == 0
    bench = spark.createDataFrame([(None, "a b")], "item_id long, text string")
    assert [r["items"] for r in dc.contaminated_spans(docs, bench).collect()] == [["None"], ["None"]]


def test_index_against_naive_search():
    rng = np.random.default_rng(0)
    runs = [rng.integers(1, 4, n) for n in rng.integers(1, 60, 40)] + [np.ones(500, int)] * 3
    index = dc.FMIndex(runs)
    flat = np.concatenate([np.append(r, 0) for r in runs])
    for n in (1, 2, 5, 10):
        pats = rng.integers(1, 5, (30, n))
        lo, hi = index.search(pats)
        for p, a, b in zip(pats, lo, hi):
            want = [i for i in range(len(flat) - n + 1) if (flat[i:i + n] == p).all()]
            assert sorted(index.locate(np.arange(a, b))) == want


def test_query_and_cut(spark):
    from txrisk.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    ids, texts = zip(*[(r.doc_id, r.text) for r in docs.collect()])
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = dict(zip(ids, _brute(texts, items)))
    got = {r.doc_id: r for r in QUERIES["op8_decontaminate"](spark, sf).collect()}
    assert any(n for _, n, _ in want.values())
    for d, (n, hit, of) in want.items():
        r = got[d]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(of), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(of).encode()).hexdigest()
    clean = dc.decontaminate(docs.withColumn("items", F.lit(1)), bench).collect()
    after = dict(zip([r.doc_id for r in clean], _brute([r.text for r in clean], items)))
    assert all(a[1] == 0 and a[0] == want[d][0] - want[d][1] for d, a in after.items())
    assert all(r.text == t for r, t in zip(sorted(clean, key=lambda r: r.doc_id), [t for _, t in sorted(zip(ids, texts))])
               if want[r.doc_id][1] == 0)
