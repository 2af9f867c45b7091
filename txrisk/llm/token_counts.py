"""Token counts of whole texts without materialising ids.

Pieces are counted once per distinct pre-token over the whole corpus, the
counts are joined to the per-document pre-token frequencies, and summed.

A pre-token is a stretch of text that no piece of the vocabulary can leave:
pieces never hold a blank after another character or a line end, and (checked
against the loaded vocabulary) never an ASCII letter, digit or Latin letter
followed by ASCII punctuation. Merges therefore never cross its borders and the
counts of the parts add up to the count of the whole text.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, save

_LATIN = "0-9A-Za-zÀ-ɏ"
_PUNCT = re.escape("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_PRETOKEN = re.compile(f" *+[{_LATIN}]++(?=[{_PUNCT} \n]|\\Z)| *+[^ \n]++| ++")
HEAD_ENTRIES = 1 << 18      # most pre-tokens that are broadcast
HEAD_BYTES = 64             # longest pre-token that is broadcast
_FLUSH = 1 << 19            # distinct pre-tokens a task holds before it emits them


def _pretokens(text: str) -> list[str]:
    return _PRETOKEN.findall(" " + text.replace("▁", " "))


def check_vocabulary(model_path: str) -> None:
    """Raise unless the model's pieces respect the pre-token borders."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    inner = re.compile(f"[^▁]▁|\n|[{_LATIN}][{_PUNCT}]")
    bad = [p for p in map(sp.id_to_piece, range(sp.get_piece_size()))
           if inner.search(p) and not re.fullmatch("<.*>", p)]
    if bad or sp.encode("\n a") != sp.encode("\n") + sp.encode("a"):
        raise ValueError(f"pieces cross pre-token borders: {bad[:5]}")


def _count(it):
    """Texts -> (pre-token, occurrences), combined within the task."""
    schema = pa.schema([("token", pa.string()), ("n", pa.int64())])
    seen: Counter = Counter()
    for b in it:
        for t in b.column(0).to_pylist():
            seen.update(_pretokens(t))
            if len(seen) > _FLUSH:
                yield from batches({"token": list(seen), "n": list(seen.values())}, schema)
                seen.clear()
    yield from batches({"token": list(seen), "n": list(seen.values())}, schema)


def _encode(model_path: str):
    def run(it):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        # A leading "\n" (always one piece) keeps the encoder's own blank apart.
        extra = len(sp.encode("\n"))
        for b in it:
            ids = sp.encode(["\n" + t for t in b.column("token").to_pylist()], num_threads=1)
            n = pa.array([len(x) - extra for x in ids], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("token"), b.column("n"), n],
                                             names=["token", "n", "pieces"])
    return run


def _per_document(head):
    schema = pa.schema([("id", pa.string()), ("n_bytes", pa.int64()), ("head", pa.int64()),
                        ("tail", pa.list_(pa.struct([("token", pa.string()), ("n", pa.int64())])))])

    def run(it):
        known = head.value
        for b in it:
            for start in range(0, b.num_rows, 500):
                part = b.slice(start, 500)
                out = {"id": part.column(0).to_pylist(), "n_bytes": [], "head": [], "tail": []}
                for t in part.column(1).to_pylist():
                    total, tail = t.count("\n"), []
                    for w, k in Counter(_pretokens(t)).items():
                        p = known.get(w)
                        if p is None:
                            tail.append({"token": w, "n": k})
                        else:
                            total += p * k
                    out["n_bytes"].append(len(t.encode()))
                    out["head"].append(total)
                    out["tail"].append(tail)
                yield from batches(out, schema)
    return run


def _frequent(pieces: DataFrame, entries: int) -> dict[str, int]:
    """The most frequent pre-tokens, at most ``entries`` of them, by a cut on a
    histogram of frequencies (the hot join keys; never more than the bound)."""
    short = pieces.where(F.octet_length("token") <= HEAD_BYTES)
    level = F.floor(F.log2("n") * 8).cast("int")
    hist = sorted(((r["l"], r["c"]) for r in
                   short.groupBy(level.alias("l")).agg(F.count("*").alias("c")).collect()), reverse=True)
    total, cut = 0, None
    for lv, c in hist:
        if total + c > entries:
            break
        total, cut = total + c, lv
    if cut is None:
        return {}
    t = short.where(level >= cut).select("token", "pieces").toArrow()
    return dict(zip(t.column(0).to_pylist(), t.column(1).to_pylist()))


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 head_entries: int = HEAD_ENTRIES) -> DataFrame:
    """Return ``id_col, n_bytes, n_tokens`` for every row of ``docs``.

    The most frequent pre-tokens (at most ``head_entries``) reach the tasks as
    a bounded broadcast, so no hot key is shuffled; all others are joined by a
    shuffle. Null texts count as empty (0 bytes, 0 tokens); an empty text has
    no token. Repeated rows and null ids each keep their own result row; other
    columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    check_vocabulary(model_path)
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).cast("string").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = rows.where("text != ''").select("text").mapInArrow(_count, "token string, n long")
    pieces = save(counted.groupBy("token").agg(F.sum("n").alias("n"))
                  .mapInArrow(_encode(model_path), "token string, n long, pieces int"), "pieces")
    head = spark.sparkContext.broadcast(_frequent(pieces, head_entries))
    # The dummy blank in front makes an empty text one pre-token: leave it out.
    per_doc = rows.mapInArrow(_per_document(head), "id string, n_bytes long, head long, "
                              "tail array<struct<token:string,n:long>>")
    per_doc = save(per_doc.withColumn("uid", F.monotonically_increasing_id()), "per-document")
    tail = (per_doc.select("uid", F.explode("tail").alias("t")).select("uid", "t.token", "t.n")
            .join(pieces.select("token", "pieces"), "token")
            .groupBy("uid").agg(F.sum(F.col("n") * F.col("pieces")).alias("tail_tokens")))
    return (per_doc.select("uid", "id", "n_bytes", "head").join(tail, "uid", "left")
            .select(F.col("id").cast(id_type).alias(id_col), "n_bytes",
                    F.when(F.col("n_bytes") == 0, F.lit(0).cast("long"))
                    .otherwise(F.col("head") + F.coalesce("tail_tokens", F.lit(0))).alias("n_tokens")))
