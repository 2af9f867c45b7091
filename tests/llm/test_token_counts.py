import public_tokenizers
import sentencepiece
from pyspark.sql import types as T

from txrisk.llm.token_counts import token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("token", T.StringType()), T.StructField("n", T.LongType())])
TEXTS = [None, "", " ", "a", "the cat, the dog.\nThe end", "  two  blanks   three", "\n\n x\n", "tab\tsep \t x",
         "</s> <s> <unk> <0x0A>", "▁▁a ▁b", "“quote”,x”, …y»", "emoji 🙂 日本語 テスト。", "nul\x00char", "a.b,c;d:e-f_g",
         "word " * 30_000, "x" * 5000, "the cat, the dog.\nThe end", "ünïcödé, straße. ñandú", "end ", "..., --- ''' don't"]


def _expected(texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return [len(sp.encode(t or "")) for t in texts]


def test_equals_the_library(spark):
    df = spark.createDataFrame([(i, t, "clash", 7) for i, t in enumerate(TEXTS)], SCHEMA)
    for head in (0, 10, 1 << 18):      # all joined, some, all broadcast
        got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts(df, MODEL, head_entries=head).collect()}
        assert got == {i: (len((t or "").encode()), n) for i, (t, n) in enumerate(zip(TEXTS, _expected(TEXTS)))}


def test_repeated_null_and_empty(spark):
    df = spark.createDataFrame([(1, "a b", None, None), (1, "a b", None, None), (1, "c", None, None),
                                (None, "d e f", None, None)], SCHEMA)
    got = sorted((r.doc_id or -1, r.n_tokens) for r in token_counts(df, MODEL).collect())
    assert got == [(-1, 3), (1, 1), (1, 2), (1, 2)]
    assert token_counts(df.limit(0), MODEL).count() == 0


def test_corpus(spark):
    from txrisk.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_tokens, r.over_limit) for r in QUERIES["op10_token_counts"](spark, sf).collect()}
    assert got == {d: (n, n > 4096) for d, n in zip(docs, _expected(docs.values()))}
