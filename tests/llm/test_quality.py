import math
import zlib

import numpy as np

from txrisk.llm import quality as qu


def test_passages_cover_whole_texts():
    texts = ["", None, "a" * 512, "b" * 513, "word word word Other", "é" * 700 + " x" * 5000]
    x, bags = qu.encode(texts)
    assert bags.tolist() == [1, 1, 1, 2, 1, -(-(1400 + 10000) // 512)]
    one, _ = qu.encode([texts[4]])
    np.testing.assert_allclose(x[5], one[0])               # neighbours do not leak into a text
    assert x[5][qu._CLASSES] == 0.5                        # two of four words repeat the one before
    whole = qu.encode([texts[5]])[0]
    assert not np.allclose(whole[0], whole[-1])


def _slow_score(m, text):
    """Score of one text by loops over passages, words and units."""
    raw = (text or "").encode()
    spaces = b" \t\n\r\x0b\x0c"
    words, at = [], 0           # (start, word)
    while at < len(raw):
        if raw[at] in spaces:
            at += 1
            continue
        end = at
        while end < len(raw) and raw[end] not in spaces:
            end += 1
        words.append((at, raw[at:end]))
        at = end
    hidden, energy = [], []
    for k in range(max(1, -(-len(raw) // qu.PASSAGE))):
        part = raw[k * qu.PASSAGE:(k + 1) * qu.PASSAGE]
        x = [0.0] * qu.FEATURES
        for c in part:
            x[qu._CLASS[c]] += 1
        x[:qu._CLASSES] = [math.sqrt(v / max(1, len(part))) for v in x[:qu._CLASSES]]
        own = [w for a, w in words if a // qu.PASSAGE == k]
        for lag in (1, 2, 3):
            same = sum(len(own[i]) == len(own[i - lag]) and own[i][:8] == own[i - lag][:8] for i in range(lag, len(own)))
            x[qu._CLASSES + lag - 1] = same / max(1, len(own))
        x[qu._CLASSES + 3] = math.log1p(sum(map(len, own)) / max(1, len(own)))
        x[qu._CLASSES + 4] = sum(len(w) == 1 for w in own) / max(1, len(own))
        x[qu._CLASSES + 5] = math.log1p(len(part)) / 6
        z = [(v - a) / s for v, a, s in zip(x, m["mean"], m["std"])]
        h = [math.tanh(sum(z[i] * m["E"][i][j] for i in range(len(z))) + m["e"][j]) for j in range(len(m["e"]))]
        e = 0.0
        for j in range(len(m["w"])):
            t = math.tanh(sum(h[i] * m["V"][i][j] for i in range(len(h))))
            g = 1 / (1 + math.exp(-sum(h[i] * m["U"][i][j] for i in range(len(h)))))
            e += m["w"][j] * t * g
        hidden.append(h)
        energy.append(e)
    weights = [math.exp(e - max(energy)) for e in energy]
    bag = [sum(w * h[j] for w, h in zip(weights, hidden)) / sum(weights) for j in range(len(hidden[0]))]
    return 1 / (1 + math.exp(-(sum(v * c for v, c in zip(bag, m["c"])) + m["b"])))


def test_scores_equal_a_slow_version():
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("aB3é.-"), rng.integers(1, 12)))     # noqa: E731
    texts = [None, "", " ", "a", "word word word", "x" * 512, "x" * 513, "Tab\tand\nline " * 90, "é" * 600,
             *(" ".join(word() for _ in range(n)) for n in (3, 100, 700, 400))]
    x, bags = qu.encode(texts)
    m = qu.start_model(x.astype(float))
    m["e"], m["b"] = rng.normal(size=16), 0.3
    np.testing.assert_allclose(qu.scores(m, texts), [_slow_score(m, t) for t in texts], rtol=1e-5, atol=1e-6)
    tied = qu.scores(m, [texts[9]] * 4 + ["", None])
    assert len(set(tied[:4])) == 1 and tied[4] == tied[5]
    long = "some words here. " * 100_000        # encoded by itself, counted in slices
    assert abs(qu.scores(m, [long])[0] - qu.scores(m, ["a", long, "b"])[1]) < 1e-12
    small = qu._COUNTED
    try:
        qu._COUNTED = 3
        again = qu.encode(texts)
    finally:
        qu._COUNTED = small
    np.testing.assert_array_equal(again[0], x)


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(0)
    x, bags, y = rng.normal(size=(9, 5)), np.array([3, 1, 4, 1]), np.array([1.0, 0.0, 0.4, 1.0])
    m = qu.start_model(x)
    m["e"], m["b"] = rng.normal(size=16) * 0.2, np.float64(0.1)

    def loss(m):
        p = qu._forward(m, x, bags)[-1]
        decay = sum((m[k] ** 2).sum() for k in "EVU") * qu._DECAY / 2
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean() + decay

    grad, step = qu.gradients(m, x, bags, y), 1e-6
    for k in qu._SHAPES:
        flat = np.atleast_1d(np.array(m[k], float))
        numeric = np.zeros(flat.size)
        for i in range(flat.size):
            ends = []
            for sign in (1, -1):
                moved = flat.copy()
                moved.flat[i] += sign * step
                ends.append(loss({**m, k: moved.reshape(np.shape(m[k]))}))
            numeric[i] = (ends[0] - ends[1]) / (2 * step)
        np.testing.assert_allclose(np.ravel(grad[k]), numeric, rtol=1e-4, atol=1e-8, err_msg=k)
    fitted = qu.fit(x, bags, np.round(y))
    a = qu._forward(fitted, x, bags)[4]
    np.testing.assert_allclose(np.add.reduceat(a, [0, 3, 4, 8]), 1)


def test_sampled_documents_are_whole(spark, monkeypatch):
    """A document is in the fit with all its passages, or not at all."""
    docs = spark.createDataFrame([(i, "word " * (300 * (i % 7) + 1)) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    seen = {}
    monkeypatch.setattr(qu, "fit", lambda x, bags, y: seen.update(bags=bags, y=y) or qu.start_model(x))
    passages = lambda i: -(-5 * (300 * (i % 7) + 1) // 512)      # noqa: E731
    usable = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    qu.train(docs, labels)
    assert sorted(seen["bags"]) == sorted(passages(i) for i in usable)
    monkeypatch.setattr(qu, "SAMPLE_PASSAGES", 100)
    qu.train(docs, labels)
    assert 80 < seen["bags"].sum() <= 100 and not set(seen["bags"]) - {passages(i) for i in range(7)}


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 0), (1, "", 0), (None, "x", 0), (2, "w " * 60_000, 0)],
                                 "doc_id long, text string, score int")
    none = spark.createDataFrame([(1, None, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    assert qu.train(docs, none) is None
    rows = qu.score_documents(docs, None).collect()
    assert [r.score for r in rows] == [0.5] * 4
    one = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    model = qu.train(docs, one)
    got = [r.score for r in qu.score_documents(docs, model).collect()]
    assert all(0 <= s <= 1 for s in got) and got[0] == got[1]
    assert qu.score_documents(docs.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    from txrisk.llm.queries import QUERIES
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op5_quality"](spark, sf).collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    test = [(rows[d].score, q) for d, q in labels if rows[d].held_out]
    assert len(test) > 500
    hit = np.mean([(s >= 0.3) == q for s, q in test])
    kept = np.mean([s >= 0.3 for s, q in test if q == 1])
    print("held-out accuracy", hit, "kept", kept)
    assert hit > 0.98 and kept > 0.995
