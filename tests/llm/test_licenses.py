import math
import re
from collections import defaultdict

from txrisk.llm.licenses import BASE, INDEXED, LOOKED_UP, PLAIN, SHARE, TEMPLATES, license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _brute(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    hits = [(i, label) for p, label in BASE for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    places = [i for i, _ in hits]
    return (len(w), len(hits), min(places, default=None), max(places, default=None),
            ",".join(sorted({x for _, x in hits})))


TEXTS = [None, "", "plain words", "Released under the MIT License.", "mit licenses are not it, mit der license",
         "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.",
         "This work is licensed under the GNU General Public License, version 3. gnu general public license",
         "gnu general public", "cc by cc by cc by-sa", "ÉMIT LICENSE mit\x00license", "word " * 30_000 + "mit license",
         "mit license " * 5000, "Released under the MIT License.", "Redistribution and use in source and binary forms, "
         "with or without modification, are permitted provided that the following conditions are met",
         "permission redistribution apache gnu license conditions compliance software"]


def test_places_and_labels(spark):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, "cc by", "x", 1)],
                               "doc_id long, text string, labels string, uid int")
    rows = {r.doc_id: r for r in license_scan(df).collect()}
    assert len(rows) == len(TEXTS) + 1
    for i, t in [*enumerate(TEXTS), (None, "cc by")]:
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == _brute(t)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert rows[5].labels == "apache,apache-2.0,cc-by,cc-by-nc"
    assert rows[6].labels == "gpl,gpl-3.0" and rows[13].labels == "bsd" and rows[13].score == 1.0
    assert rows[3].labels == "mit" and rows[3].score == 1.0 and rows[14].labels == "" and rows[2].score == 0
    assert license_scan(df.limit(0)).count() == 0


def test_every_notice_is_found(spark):
    df = spark.createDataFrame([(i, "ein wort davor " + t + " und danach") for i, (_, t, _) in enumerate(TEMPLATES)],
                               "doc_id long, text string")
    for r in license_scan(df).collect():
        assert TEMPLATES[r.doc_id][0] in r.labels.split(",")


def test_query(spark):
    from txrisk.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op7_licenses"](spark, sf).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got} == \
        {d: _brute(t) for d, t in docs.items()}
    assert any(r.n_base for r in got) and all(r.labels == "" for r in got if r.n_base == 0)


def _brute_method(texts):
    """(labels, score) of every text by the whole method, one text at a time."""
    lower = [WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) for t in texts]
    notices = [(label, WORD.findall(t.lower()), p.split()) for label, t, p in TEMPLATES]
    vocabulary = {w for _, t, _ in notices for w in t} - PLAIN
    idf = {v: math.log((len(texts) + 1) / (sum(v in set(w) for w in lower) + 1) + 1) for v in vocabulary}
    index = []
    for label, t, phrase in notices:
        kept = sorted(((-idf[w], w, i) for i, w in enumerate(t) if w not in PLAIN))[:INDEXED]
        index.append((label, phrase, len(t), [(w, i) for _, w, i in kept], -sum(x for x, _, _ in kept)))
    out = []
    for w, (_, _, _, _, base) in zip(lower, map(_brute, texts)):
        labels, score = set(filter(None, base.split(","))), 0.5 if base else 0.0
        looked = sorted(set(w) & vocabulary, key=lambda v: (-idf[v], v))[:LOOKED_UP]
        shares = []
        for label, phrase, size, tokens, weight in index:
            got = defaultdict(float)
            for v, at in tokens:
                if v in looked:
                    for i in (i for i, x in enumerate(w) if x == v):
                        got[i - at] += idf[v]
            places = [i for i in range(len(w)) if w[i:i + len(phrase)] == phrase]
            for offset, g in got.items():
                if g / weight >= SHARE and any(offset <= i <= offset + size for i in places):
                    labels.add(label)
                    shares.append(min(1.0, g / weight))
        out.append((",".join(sorted(labels)), max(shares, default=score)))
    return out


def test_method_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    cut = [" ".join(t.split()[k:]) for k, (_, t, _) in enumerate(TEMPLATES)]
    texts += [t for t in TEXTS if t is None or len(t) < 20_000] + cut + [a[1] + " and " + b[1] for a, b in zip(TEMPLATES, TEMPLATES[3:])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license_scan(df).collect()}
    for i, (labels, score) in enumerate(_brute_method(texts)):
        assert got[i][0] == labels and abs(got[i][1] - score) < 1e-9, (i, got[i], labels, score)


def test_many_notices_in_one_file(spark):
    """Notices of commoner words stay when others in the file have rarer ones."""
    every = "\n".join(t for _, t, _ in TEMPLATES)
    four = [t for label, t, _ in TEMPLATES if label in ("lgpl", "cc-by")] + [TEMPLATES[8][1], TEMPLATES[5][1]]
    nc = [t for label, t, _ in TEMPLATES if label in ("bsd", "isc", "lgpl", "cc-by-nc")]
    texts = [every, "\n".join(four), "\n".join(nc)] + [t for _, t, _ in TEMPLATES] * 3 + ["no notice"] * 40
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_scan(df).collect()}
    assert set(got[0].split(",")) == {label for label, _, _ in TEMPLATES}
    assert {"lgpl", "mit", "apache-2.0", "cc-by"} <= set(got[1].split(","))
    assert {"bsd", "isc", "lgpl", "cc-by-nc"} <= set(got[2].split(","))
