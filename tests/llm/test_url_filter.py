"""URL lists against a loop over all entries, and the filter by itself."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from txrisk.llm.url_filter import BlockedBloom, candidates, canonical, listed, url_verdicts

RULES = "host string, path string, verdict string"


def _split(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def _judge(url, rules, default="allow"):
    host, path = _split(url)
    fits = {}
    for h, p, v in rules:
        if h is None or v is None:
            continue
        h, p = _split("x://" + h)[0], p or ""
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            key = (len(h) + len(p), len(h), h + p)
            fits[key] = max(v, fits.get(key, ""))
    best = max(fits, default=None)
    return host, path, best and best[2], fits[best] if best else default


def _check(spark, urls, rules, **kw):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    out = url_verdicts(pages, spark.createDataFrame(rules, RULES), **kw).collect()
    assert len(out) == len(urls)
    for r in out:
        assert tuple(r)[1:] == _judge(urls[r.page_id], rules), urls[r.page_id]
    return out


def test_random_lists(spark):
    rng = random.Random(5)
    labels, parts = ["a", "b", "com", "x-y", "", "É"], ["", "/", "/a", "/ab/", "/b?c", "#d", "/É/a", "/a//b"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    path = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(0, 3)))
    rules = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(120)]
    urls = [f"{rng.choice(['http', 'HTTPS'])}://{host().upper() if rng.random() < .3 else host()}{path()}"
            for _ in range(800)]
    _check(spark, urls, rules)
    _check(spark, urls[:200], rules, max_blocks=1)      # a filter of one block: false positives, same verdicts


def test_edges(spark):
    rules = [("org", "/", "allow"), ("Example.ORG", "/es/", "block"), ("example.org", "/es/", "allow"), ("t.org", None, "block"),
             (None, "/", "block"), ("net", "/", None)]
    long = "http://" + "a." * 3000 + "org/" + "p" * 200_000
    urls = [None, "", "://", "x", "http://", "http://org", "http://org/", "http://example.org/es/1", "http://t.org",
            "http://t.org?x", "http://xt.org/", "http://a.T.org/#", "http://e.net/", "http://u:p@example.org:80/es/",
            "a://b://org/", long, "http://org/\nq", *["http://www.example.org/es/1"] * 40]
    _check(spark, urls, rules)


def test_empty_tables_and_no_rules(spark):
    rules = spark.createDataFrame([("org", "/", "block")], RULES)
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_verdicts(none, rules).count() == 0
    pages = spark.createDataFrame([(1, "http://org/"), (None, "http://org/"), (None, None)], "page_id long, url string")
    got = url_verdicts(pages, rules.limit(0), default="block").collect()
    assert [(r.rule, r.verdict) for r in got] == [(None, "block")] * 3
    assert sorted(r.verdict for r in url_verdicts(pages, rules).collect()) == ["allow", "block", "block"]


def test_filter_misses_nothing_and_is_sharp(spark):
    keys = spark.range(20_000).select(F.xxhash64(F.lit("block"), "id").alias("at"), F.xxhash64(F.lit("bits"), "id").alias("bits"))
    bloom = BlockedBloom.of(keys)
    assert bloom.bytes == 64 * -(-20_000 // 32)
    hashes = F.array(F.struct(F.xxhash64(F.lit("block"), "id").alias("at"), F.xxhash64(F.lit("bits"), "id").alias("bits")))
    probes = spark.range(40_000).withColumn("k", F.array("id"))
    got = {r.id: bool(r.k) for r in bloom.passing(probes, "k", hashes).collect()}
    assert all(got[i] for i in range(20_000))
    assert np.mean([got[i] for i in range(20_000, 40_000)]) < 0.01


def test_only_listed_shapes_become_keys(spark):
    rules = listed(spark.createDataFrame([("b.com", "/x/", "block")], RULES))
    pages = spark.createDataFrame([("http://a.b.com/x/y",), ("http://b.com/q/",), ("http://com/x/",)], "url string")
    host, path = canonical(F.col("url"))
    keys = [r["keys"] for r in candidates(pages.select(host.alias("host"), path.alias("path")), rules).collect()]
    assert keys[0] == [("b.com", "/x/")] and keys[1] in ([], [("b.com", "/q/")]) and keys[2] == []


@pytest.mark.parametrize("url,want", [("HTTP://A.b/C?d", ("a.b", "/C")), ("s://h#f/x", ("h", "")), ("nope", ("", ""))])
def test_canonical(spark, url, want):
    host, path = canonical(F.col("url"))
    r = spark.createDataFrame([(url,)], "url string").select(host.alias("h"), path.alias("p")).first()
    assert tuple(r) == want
