"""WARC archives: write pages, read them back with boundary-chain verification.

Archives are split anywhere. Tasks cut their part at every record magic and
emit candidates: byte offset and the successor offset that the record's
Content-Length claims. Only candidates reachable from the start of their file
are records; a magic inside a payload is never reached and is joined back to
the payload it belongs to.

A successor that is just the next candidate needs no pointer of its own:
stretches of such candidates form one run, and pointer jumping doubles its
reach over runs, so its rounds follow the logarithm of the embedded magics.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save, shared_folder
from .url_filter import BlockedBloom, hashes

MAGIC = "WARC/1.1\r\n"
_M = len(MAGIC)
_END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 SHA-1."""
    return _base32(F.sha1(data))


def _base32(digest: Column) -> Column:
    """Base32 of 40 hex digits: five of them at a time are four base32 ones."""
    parts = []
    for k in range(0, 40, 5):
        value = F.conv(F.substring(digest, k + 1, 5), 16, 10).cast("int")
        parts += [F.lit(_BASE32).substr(F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def _with_first(rows: DataFrame, min_bytes: int) -> DataFrame:
    """``rows`` plus ``first``: the id that a shared payload is a response under
    (null: nothing else has the payload). The body of a revisit may be null.

    Only digests are grouped. A Bloom filter of the shared ones passes to the
    scan: rows outside it are unique and stay where they are. Rows inside it
    are joined with the shared digests, and of those only rows that a second
    filter marks as responses (or that the first one held by mistake) take
    their payload through the shuffle.
    """
    key = ["sha", "size"]
    light = save(rows.where(F.col("size") >= min_bytes).select(*key, "id"), "warc-digests")
    shared = save(light.groupBy(*key).agg(F.max("id").alias("first"), F.count("*").alias("n"))
                  .where("n > 1 and first is not null").drop("n"), "warc-shared")
    if shared.isEmpty():
        return rows.withColumn("first", F.lit(None).cast("long"))

    def filter_of(df, columns):
        at, bits = hashes(*map(F.col, columns))
        return BlockedBloom.of(df.select(at.alias("at"), bits.alias("bits")))

    some = filter_of(shared, key)
    perhaps = (F.col("size") >= min_bytes) & some.holds(*hashes(*map(F.col, key)))
    by_mistake = light.where(perhaps).join(shared, key, "left_anti")
    written = filter_of(by_mistake.unionByName(shared.select(*key, F.col("first").alias("id"))), [*key, "id"])
    marked = rows.withColumn("perhaps", perhaps)
    inside = marked.where("perhaps").withColumn("needed", written.holds(*hashes(*map(F.col, [*key, "id"])))) \
        .withColumn("body", F.when(F.col("needed"), F.col("body"))).drop("perhaps", "needed")
    outside = marked.where("not perhaps").drop("perhaps").withColumn("first", F.lit(None).cast("long"))
    return outside.unionByName(inside.join(shared, key, "left"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id",
                   url_col: str = "url", payload_col: str = "html") -> None:
    """One record per row: of equal payloads of at least ``min_bytes`` bytes the
    largest id is written as response, the others as revisits of it.

    A null payload is empty. A null id is never referred to: such rows are
    revisits where their payload has an id, else responses. Rows that repeat
    the largest id are all responses.
    """
    body = F.coalesce(payload_col, F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"),
                        F.regexp_replace(F.coalesce(url_col, F.lit("")), r"[\x00-\x20\x7F]", "%20").alias("url"),
                        body.alias("body")) \
        .withColumn("sha", F.unhex(F.sha1("body"))).withColumn("size", F.octet_length("body"))
    joined = _with_first(rows, min_bytes)
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    block = F.when(revisit, F.lit(_HTTP)).otherwise(F.concat(F.lit(_HTTP), F.col("body").cast("string")))
    name = F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))
    lines = [F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
             F.concat(F.lit("WARC-Record-ID: "), name),
             F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
             F.concat(F.lit("WARC-Payload-Digest: sha1:"), _base32(F.hex("sha"))),
             F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:x-page:"), F.col("first").cast("string"), F.lit(">"))),
             F.when(revisit, F.lit(f"WARC-Profile: {_PROFILE}")),
             F.lit("Content-Type: application/http; msgtype=response"),
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    record = F.concat(F.lit(MAGIC), F.concat_ws("\r\n", *lines), F.lit(_END), block)
    joined.select(record.alias("value")).write.option("lineSep", _END).option("compression", "none").text(path)


def _segments(spark, path: str) -> DataFrame:
    """Text between magics, in file order: file, size, block, nth, text."""
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_size"),
                      F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("nth"), F.col("value").alias("text"))


def _parsed(df: DataFrame) -> DataFrame:
    """Header fields, claimed length and payload facts of a segment's text."""
    def field(name, pattern):
        return F.nullif(F.regexp_extract("head", rf"(?i)(?:^|\r\n){name}:[ \t]*{pattern}[ \t]*(?:\r\n|$)", 1), F.lit(""))
    df = df.withColumn("head", F.substring_index("text", _END, 1)).withColumn("head_size", F.octet_length("head"))
    df = df.withColumn("content", F.when(F.octet_length("text") >= F.col("head_size") + 4,
                                         F.try_to_number(field("Content-Length", r"(\d{1,15})"), F.lit("9" * 15))
                                         .cast("long")))
    block = F.col("text").cast("binary").substr(F.col("head_size") + 5, F.col("content").cast("int"))
    df = df.withColumn("block_bytes", block)
    http = F.octet_length(F.substring_index(F.col("block_bytes").cast("string"), _END, 1)) + 4
    df = df.withColumn("payload", F.col("block_bytes").substr(http + 1, F.octet_length("block_bytes")))
    return df.withColumn("type", field("WARC-Type", r"(\S+)")) \
        .withColumn("id", field("WARC-Record-ID", r"<urn:x-page:(-?\d+)>").cast("long")) \
        .withColumn("refers_to", field("WARC-Refers-To", r"<urn:x-page:(-?\d+)>").cast("long")) \
        .withColumn("claimed_digest", field("WARC-Payload-Digest", r"sha1:(\S+)")) \
        .withColumn("span", F.lit(_M + 8) + F.col("head_size") + F.col("content")) \
        .withColumn("payload_bytes", F.octet_length("payload").cast("long")) \
        .withColumn("payload_digest", base32_sha1(F.col("payload"))) \
        .drop("head", "head_size", "content", "block_bytes", "payload", "text")


def _before(df: DataFrame, what: Column, name: str, how) -> DataFrame:
    """``how`` of ``what`` over all earlier rows of the file: within the block,
    joined with the blocks before it, so no task holds a whole file."""
    past = Window.partitionBy("file", "block").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    blocks = df.groupBy("file", "block").agg(how(what).alias("_of"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", how(F.col("_of")).over(earlier).alias("_earlier"))
    return df.withColumn("_within", how(what).over(past)).join(blocks, ["file", "block"]) \
        .withColumn(name, F.struct("_earlier", "_within")).drop("_earlier", "_within")


def _reached(runs: DataFrame) -> DataFrame:
    """Pointer jumping: run starts (file, at) reachable from offset 0."""
    found = save(runs.where("start = 0").select("file", F.col("start").alias("at")).distinct(), "reached")
    jump, known = runs.select("file", "start", "succ"), -1
    while (n := found.count()) != known:
        known = n
        here = jump.withColumnRenamed("start", "at")
        found = save(found.unionByName(found.join(here, ["file", "at"]).select("file", F.col("succ").alias("at")))
                     .distinct(), "reached")
        on = jump.select("file", F.col("start").alias("succ"), F.col("succ").alias("further"))
        jump = save(jump.join(on, ["file", "succ"]).select("file", "start", F.col("further").alias("succ")), "jump")
    return found


def read_archives(spark, path: str) -> DataFrame:
    """Verified records: ``id, type, refers_to, payload_bytes, payload_digest``
    (of the stored payload), ``claimed_digest, file, offset``."""
    segments = _segments(spark, path)
    sha = F.unhex(F.sha2(F.col("text"), 256))
    parsed = save(_parsed(segments.withColumn("size", F.octet_length("text").cast("long")).withColumn("sha", sha)),
                  "warc-segments")
    placed = _before(parsed, F.col("size") + _M, "before", F.sum) \
        .withColumn("offset", F.coalesce("before._earlier", F.lit(0)) + F.coalesce("before._within", F.lit(0)) - _M)
    placed = save(placed.drop("before").withColumn("next", F.col("offset") + _M + F.col("size"))
                  .withColumn("succ", F.col("offset") + F.col("span")), "warc-candidates")
    ends = placed.groupBy("file").agg(F.max("next").alias("end"), F.max("file_size").alias("file_size"))
    if not ends.where("end <> file_size").isEmpty():
        raise ValueError("an archive was not read whole")
    # Runs: cut after every candidate whose successor is not the next one, and at its target.
    candidates = placed.where("offset >= 0")
    odd = save(candidates.where("succ is null or succ <> next").select("file", "next", "succ"), "warc-odd")
    cuts = odd.select("file", F.col("next").alias("start")) \
        .unionByName(odd.where("succ is not null").select("file", F.col("succ").alias("start"))) \
        .unionByName(candidates.where("offset = 0").select("file", F.col("offset").alias("start"))).distinct()
    follow = Window.partitionBy("file").orderBy("start")
    runs = cuts.withColumn("next", F.lead("start").over(follow)) \
        .join(odd.withColumn("odd", F.lit(True)), ["file", "next"], "left") \
        .select("file", "start", F.when(F.col("odd"), F.col("succ")).otherwise(F.col("next")).alias("succ"))
    runs = save(runs, "warc-runs")
    marks = runs.select("file", F.col("start").alias("at")) \
        .join(_reached(runs).withColumn("hit", F.lit(True)), ["file", "at"], "left") \
        .select("file", F.col("at").alias("offset"), F.coalesce("hit", F.lit(False)).alias("hit"))
    # The last run start at or before a candidate says whether it is a record.
    marked = candidates.join(marks, ["file", "offset"], "left")
    marked = _before(marked, F.when(F.col("hit").isNotNull(), F.struct("offset", "hit")), "run", F.max)
    verdict = F.coalesce("hit", F.greatest("run._earlier", "run._within").getField("hit"), F.lit(False))
    marked = save(marked.withColumn("record", verdict).drop("run", "hit"), "warc-marked")
    whole = marked.where("record and succ = next")
    # Records with a magic in their payload: join their segments' text again, by
    # its digest, since another scan may split the archives elsewhere.
    part = _before(marked, F.when(F.col("record"), F.col("offset")), "owner", F.max) \
        .withColumn("owner", F.when(F.col("record"), F.col("offset"))
                    .otherwise(F.greatest("owner._earlier", "owner._within")))
    torn = marked.where("record and succ > next").select("file", F.col("offset").alias("owner"))
    pieces = save(part.join(torn, ["file", "owner"]).select("file", "sha", "owner", "offset"), "warc-torn")
    columns = ["id", "type", "refers_to", "payload_bytes", "payload_digest", "claimed_digest", "file", "offset"]
    texts = segments.select(sha.alias("sha"), "text").join(pieces.select("sha"), "sha", "left_semi") \
        .groupBy("sha").agg(F.first("text").alias("text"))
    text = pieces.join(texts, "sha") \
        .groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("offset", "text"))).alias("parts")) \
        .select("file", F.col("owner").alias("offset"), F.array_join("parts.text", MAGIC).alias("text"))
    return whole.select(*columns).unionByName(_parsed(text).select(*columns))


def warc_roundtrip(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html") -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back:
    ``id_col, payload_bytes, payload_digest, record_type, refers_to`` per row.

    Revisits take size and digest of the full payload from the response that
    they refer to. Null ids, payloads and urls, repeated rows and magics inside
    payloads are handled as ``write_archives`` says; other columns are not
    read; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/archives-{uuid.uuid4().hex}"
    write_archives(pages, path, min_bytes, id_col, url_col, payload_col)
    records = save(read_archives(spark, path), "warc-records")
    if records.count() != pages.count():
        raise ValueError("not as many records were read as written")
    wrong = records.where("type = 'response' and not payload_digest <=> claimed_digest")
    if not wrong.isEmpty():
        raise ValueError("a payload differs from its digest")
    full = records.where("type = 'response' and id is not null") \
        .groupBy(F.col("id").alias("refers_to"), F.col("payload_digest").alias("claimed_digest")) \
        .agg(F.max("payload_bytes").alias("full"))
    return records.join(full, ["refers_to", "claimed_digest"], "left").select(
        F.col("id").cast(pages.schema[id_col].dataType).alias(id_col),
        F.coalesce("full", "payload_bytes").alias("payload_bytes"), F.col("claimed_digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers_to").cast(pages.schema[id_col].dataType).alias("refers_to"))
