import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from txrisk.llm import packing as pk

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_encoder_equals_the_library():
    lib, enc = Tokenizer.from_file(PATH), pk.ChunkEncoder(PATH)
    rnd = random.Random(5)
    chars = [chr(i) for i in range(256)] + list("  \n\t  'sré“…日本🙂　 Жд") * 8
    texts = ["", " ", "  a", "a  b", "a   b", "x\n \tb", "\n b", "it's a <|endoftext|> b", "<|endoftext|>", "ab " * 400]
    texts += ["".join(rnd.choice(chars) for _ in range(rnd.randrange(1, 40))) for _ in range(3000)]
    for t in texts * 2:         # the second time from memory
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def _sequences(bins):
    return sum(n for _, n in bins)


def test_histogram_packing():
    rng = np.random.default_rng(2)
    for n in (0, 1, 50, 5000, 100_000):
        hist = np.bincount(np.clip(rng.lognormal(5.5, 0.9, n), 1, 1024).astype(int), minlength=1025)
        bins = pk.pack_histogram(hist)
        used = np.zeros(1025, int)
        for lengths, k in bins:
            assert k > 0 and 0 < sum(lengths) <= 1024
            np.add.at(used, list(lengths), k)
        assert (used == hist).all()
        least = -(-int((hist * np.arange(1025)).sum()) // 1024)
        if n >= 5000:
            assert _sequences(bins) <= 1.002 * least + 1


def test_patterns_beat_best_fit_on_real_lengths(spark):
    """The lengths of sf0.01 once, 50 and 1,000 times: never more sequences than
    best fit alone, and most pieces placed by patterns."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = pk.pack(docs, PATH)
    hist = np.zeros(1025, np.int64)
    for r in pieces.groupBy("length").count().collect():
        hist[r[0]] = r[1]
    for times in (1, 50, 1000):
        h = hist * times
        short = h.copy()
        short[1024] = 0
        alone = int(h[1024]) + _sequences(pk.best_fit(short, 1024))
        plan = _sequences(pk.pack_histogram(h))
        left = short.copy()
        placed = sum(len(p) * n for p, n in pk.fitted_bins(left, 1024))
        assert plan <= alone and placed + left.sum() == short.sum()
        assert placed > 0.9 * short.sum()
        assert times == 1 or plan < alone


def test_patterns_are_all_exact_fills():
    limit, present = 24, np.array([1, 3, 4, 7, 8, 11, 12, 20, 21])
    every = {tuple(sorted(c, reverse=True)) for k in (2, 3, 4)
             for c in itertools.combinations_with_replacement(present.tolist(), k) if sum(c) == limit}
    patterns = pk.Patterns(present, limit)
    listed = {tuple(int(v) for v in sorted((x for x in r if x), reverse=True)) for r in patterns.listed}
    assert listed == {p for p in every if len(p) < 4}
    rng = np.random.default_rng(1)
    for _ in range(50):     # the steepest of all, quadruples too
        price = np.zeros(limit + 1)
        price[present] = rng.normal(size=len(present))
        best = max(sum(price[v] for v in p) for p in every)
        got = patterns.steepest(price, 3)
        assert (not got and best <= 1e-9) or np.isclose(sum(price[v] for v in got[0]), best)
        assert set(got) <= every and len({v for p in got for v in p}) == sum(len(set(p)) for p in got)


def test_fit_is_a_least_squares_optimum():
    """No negative count, no gradient along a kept pattern, none downhill outside."""
    rng = np.random.default_rng(3)
    limit = 40
    hist = rng.integers(0, 30, limit + 1)
    hist[[0, limit]] = 0
    patterns = pk.Patterns(np.flatnonzero(hist), limit)
    chosen, x = pk.fit_counts(hist, patterns, pk.merged(pk.best_fit(hist, limit)))
    a = np.array([np.append(np.bincount(p, minlength=limit + 1), pk.WASTE * (limit - sum(p))) for p in chosen])
    rest = np.append(hist, 0) - x @ a
    assert (x > 0).all() and np.abs(a @ rest).max() < 1e-3
    outside = patterns.steepest(rest[:-1], 1)
    assert not outside or sum(rest[v] for v in outside[0]) < 0.05


def _check(rows, texts):
    lib = Tokenizer.from_file(PATH)
    want = {}
    for d, t in texts:
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        parts = -(-len(ids) // 1024)
        start = 0
        for p in range(parts):
            n = len(ids) - 1024 * (parts - 1) if p == 0 else 1024
            want.setdefault((d, p, start, n, zlib.crc32(ids[start:start + n].tobytes())), 0)
            want[(d, p, start, n, zlib.crc32(ids[start:start + n].tobytes()))] += 1
            start += n
    got = defaultdict(int)
    seqs = defaultdict(list)
    for r in rows:
        got[(r[0], r.piece, r.start, r.length, r.ids_crc32)] += 1
        seqs[r.sequence_id].append((r.offset, r.length))
    assert dict(got) == want
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 1024
    return len(seqs), sum(k[3] * n for k, n in want.items())


def test_edges(spark):
    texts = [(1, None), (2, ""), (None, "a b c"), (3, "word " * 9000), (4, "same"), (4, "same"), (5, "x" * 3000)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in texts], "doc_id long, text string, length int, rank string")
    n, total = _check(pk.pack(df, PATH).collect(), texts)
    assert n <= -(-total // 1024) + 1
    assert pk.pack(df.limit(0), PATH).count() == 0


def test_query(spark):
    from txrisk.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    n, total = _check(QUERIES["op1_packing"](spark, sf).collect(), texts)
    print("sequences", n, "least", -(-total // 1024))
    assert n <= 1.01 * -(-total // 1024)
