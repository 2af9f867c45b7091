import base64
import hashlib

from txrisk.llm import warc

INNER = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:999>\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"


def _want(rows, min_bytes=0):
    best = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if i is not None and len(p) >= min_bytes:
            best[p] = max(best.get(p, i), i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        of = best.get(p)
        revisit = of is not None and i != of
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
                    "revisit" if revisit else "response", of if revisit else None))
    return sorted(out, key=repr)


ROWS = [(1, "http://a", "<p>same</p>"), (2, "http://b\r\nX: y", "<p>same</p>"), (3, None, None), (4, "", ""),
        (5, "u", "before " + INNER + " after " + INNER), (6, "u", INNER), (7, "u", "WARC/1.1\r\n"),
        (8, "u", "x\r\n\r\nWARC/1.1\r\nContent-Length: 99999999\r\n\r\n"), (9, "u", "é日🙂 \x00 \r\n\r\n"),
        (10, "u", INNER * 3), (None, "n", "<p>same</p>"), (None, "n", "alone"), (11, "u", "long " * 60_000),
        (12, "u", "r"), (12, "u", "r"), (13, "u", "WARC/1.1\r\nContent-Length: x\r\n\r\nWARC/1.1"),
        (14, "u", "y" + INNER + "\r\n\r\nWARC/1.1\r\n\r\n\r\n")]
SCHEMA = "page_id long, url string, html string, digest string, size int"


def _df(spark, rows, parts):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(parts)


def test_magic_in_payloads(spark):
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for parts, size in ((1, "128m"), (1, "211b"), (5, "1000b")):     # archives split anywhere
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = ROWS if size != "211b" else [r for r in ROWS if r[0] != 11]
            got = sorted([tuple(r) for r in warc.warc_roundtrip(_df(spark, rows, parts)).collect()], key=repr)
            assert got == _want(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)


def test_minimum_size_and_empty(spark):
    got = sorted([tuple(r) for r in warc.warc_roundtrip(_df(spark, ROWS, 2), min_bytes=5).collect()], key=repr)
    assert got == _want(ROWS, 5)
    assert warc.warc_roundtrip(_df(spark, ROWS, 1).limit(0)).count() == 0


def test_query(spark):
    from txrisk.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = sorted([tuple(r) for r in QUERIES["op6_warc"](spark, sf).collect()], key=repr)
    assert got == _want(rows)


def test_scans_that_are_split_differently(spark, monkeypatch):
    """Other splits in the second scan (as when an executor is lost) lose no page."""
    split, save = spark.conf.get("spark.sql.files.maxPartitionBytes"), warc.save

    def resplit(df, name):
        out = save(df, name)
        if name == "warc-torn":
            spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
        return out
    monkeypatch.setattr(warc, "save", resplit)
    rows = [r for r in ROWS if r[0] != 11]
    try:
        got = sorted([tuple(r) for r in warc.warc_roundtrip(_df(spark, rows, 1)).collect()], key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    assert got == _want(rows)


def test_filters_that_hold_too_much(spark, monkeypatch):
    """Filters of one block take nearly everything for shared or needed: unique
    payloads that were taken in by mistake keep their body."""
    of = warc.BlockedBloom.of
    monkeypatch.setattr(warc.BlockedBloom, "of", staticmethod(lambda keys: of(keys, max_blocks=1)))
    rows = [(i, f"u{i}", f"page {i // 2 if i % 5 == 0 else i} text") for i in range(900)] + \
        [(1000 + i, "u", f"shared {i % 150}") for i in range(450)]
    got = sorted([tuple(r) for r in warc.warc_roundtrip(_df(spark, rows, 4), min_bytes=9).collect()], key=repr)
    assert got == _want(rows, 9)


def test_few_payloads_are_shuffled(spark):
    """Of 200 unique pages and 100 copies of 10 payloads, the join that finds
    the responses gets 10 payloads (and what a filter holds by mistake)."""
    from pyspark.sql import functions as F
    rows = [(i, f"unique {i}") for i in range(200)] + [(200 + i, f"shared {i % 10}") for i in range(100)]
    df = spark.createDataFrame(rows, "id long, text string").select(
        "id", F.col("text").cast("binary").alias("body")).withColumn("sha", F.unhex(F.sha1("body"))) \
        .withColumn("size", F.octet_length("body"))
    out = warc._with_first(df, 0).collect()
    assert sum(r["first"] is not None for r in out) == 100 and len(out) == 300
    assert sum(r["first"] is not None and r["body"] is not None for r in out) <= 12
    assert all(r["body"] is not None for r in out if r["first"] is None or r["first"] == r["id"])
