import re

import regex
from pyspark.sql import functions as F

from quire.operators import bpe, chunking, tokenize
from quire.operators.tokenize import FIRST_ID, PAD_ID, UNK_ID
from tests.conftest import SF_SMALL


def _docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")


def test_pretokens_cover_text(spark):
    docs = _docs(spark)
    pt = regex.compile(tokenize.PRETOKEN_PATTERN)
    for r in docs.limit(20).collect():
        toks = pt.findall(r.text)
        assert "".join(toks) == r.text
    got = tokenize.pretokens(docs.limit(5), ["doc_id"]).groupBy("doc_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]), "")
        .alias("t")).join(docs, "doc_id")
    assert got.where(F.col("t") != F.col("text")).count() == 0


def test_vocab_ranking_and_roundtrip(spark):
    docs = _docs(spark)
    vocab = tokenize.fit_vocab(docs)
    v = vocab.orderBy("id").collect()
    assert v[0].id == FIRST_ID
    assert all((a["count"], b.token) >= (b["count"], a.token) or a["count"] > b["count"]
               for a, b in zip(v, v[1:]))
    assert [r.id for r in v] == list(range(FIRST_ID, FIRST_ID + len(v)))
    enc = tokenize.encode(docs, vocab, ["doc_id"])
    dec = tokenize.decode(enc, vocab, ["doc_id"], "ids", "back").join(docs, "doc_id")
    assert dec.where(F.col("back") != F.col("text")).count() == 0


def test_large_vocab_path_equals_broadcast_path(spark):
    """hot_size below the vocabulary size forces the broadcast + shuffle split."""
    docs = _docs(spark)
    vocab = tokenize.fit_vocab(docs)
    a = {r.doc_id: r.ids for r in tokenize.encode(docs, vocab, ["doc_id"]).collect()}
    b = {r.doc_id: r.ids for r in tokenize.encode(docs, vocab, ["doc_id"], hot_size=50).collect()}
    assert a == b
    enc = spark.createDataFrame(sorted(a.items()), "doc_id long, ids array<int>")
    d1 = {r.doc_id: r.t for r in tokenize.decode(enc, vocab, ["doc_id"], "ids", "t").collect()}
    d2 = {r.doc_id: r.t for r in tokenize.decode(enc, vocab, ["doc_id"], "ids", "t", hot_size=50).collect()}
    assert d1 == d2 and len(d1) == len(a)
    # the two encode outputs also join (sort-merge join on the key partitioning)
    ja = tokenize.encode(docs, vocab, ["doc_id"]).withColumnRenamed("ids", "a")
    jb = tokenize.encode(docs, vocab, ["doc_id"], hot_size=50).withColumnRenamed("ids", "b")
    assert ja.join(jb, "doc_id").where(F.col("a") != F.col("b")).count() == 0


def test_unknown_and_empty(spark):
    docs = _docs(spark)
    vocab = tokenize.fit_vocab(docs.limit(3))
    new = spark.createDataFrame([(1, "zzqx zzqx"), (2, "")], "doc_id long, text string")
    got = {r.doc_id: r.ids for r in tokenize.encode(new, vocab, ["doc_id"]).collect()}
    assert got[2] == [] and UNK_ID in got[1]
    back = tokenize.decode(spark.createDataFrame([(1, [0, 1])], "doc_id long, ids array<int>"),
                           vocab, ["doc_id"], "ids", "t").first()
    assert back.t == ""


def test_chunk_cases(spark):
    L = 4
    lens = [0, L - 1, L, L + 1, 2 * L - 1, 2 * L, 10 * L + 1]
    df = spark.createDataFrame([(n, list(range(n))) for n in lens], "id int, ids array<int>")
    ch = chunking.chunk(df, L, "ids", keep_ids=True).collect()
    for n in lens:
        rows = sorted((r for r in ch if r.id == n), key=lambda r: r.chunk_idx)
        assert len(rows) == n // L
        flat = [x for r in rows for x in r.input_ids]
        assert flat == list(range(n))[: (n // L) * L]
        assert all(r.attention_mask == [1] * L and r.start == r.chunk_idx * L for r in rows)


def test_article_truncation(spark):
    df = spark.createDataFrame([(1, list(range(3000)))], "id int, ids array<int>")
    assert chunking.article_chunks(df, 256, "ids").count() == 11  # whole articles
    assert chunking.article_chunks(df, 256, "ids", max_tokens=2048).count() == 8
    assert chunking.article_chunks(df, 64, "ids", max_tokens=640).count() == 10


def test_pad_mask_shift(spark):
    L = 5
    rows = [(n, [7] * n) for n in (0, 1, L - 1, L, L + 1)] + [(9, [PAD_ID, 3])]
    df = spark.createDataFrame(rows, "id int, ids array<int>")
    out = {r.id: r for r in chunking.shift(chunking.pad(df, L, "ids")).collect()}
    for n in (0, 1, L - 1, L, L + 1):
        m = min(n, L)
        assert out[n].input_ids == [7] * m + [PAD_ID] * (L - m)
        assert out[n].attention_mask == [1] * m + [0] * (L - m)
        assert out[n].labels == out[n].input_ids[1:]
        assert out[n].dec_input_ids == out[n].input_ids[:-1]
        assert out[n].dec_attention_mask == out[n].attention_mask[:-1]
    assert out[9].attention_mask == [1, 1, 0, 0, 0]


def test_one_vs_many_partitions(spark):
    docs = _docs(spark)
    v1 = tokenize.fit_vocab(docs.coalesce(1))
    v8 = tokenize.fit_vocab(docs.repartition(8))
    assert sorted(v1.collect()) == sorted(v8.collect())


def test_gpt2_pattern_java_runs(spark):
    df = spark.createDataFrame([("I'm here  now",)], "t string")
    toks = df.select(tokenize.pretoken_array("t", tokenize.GPT2_PATTERN)).first()[0]
    assert toks == re.findall(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?[^\s\w]+|\s+(?!\S)|\s+", "I'm here  now")


def test_repeated_rows_stay_apart(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "b"), (2, None), (2, None)], "doc_id long, text string")
    vocab = tokenize.fit_vocab(docs)
    for hot in (tokenize.HOT_VOCAB, 1):
        enc = tokenize.encode(docs, vocab, ["doc_id"], hot_size=hot)
        assert enc.columns == ["doc_id", "ids"]
        back = tokenize.decode(enc, vocab, ["doc_id"], hot_size=hot)
        assert sorted((r.doc_id, r.text) for r in back.collect()) == [(1, "a b"), (1, "a b"), (1, "b"), (2, ""), (2, "")]
    got = bpe.bpe_encode(docs, [], ["doc_id"]).collect()
    assert sorted((r.doc_id, len(r.ids or [])) for r in got) == [(1, 1), (1, 3), (1, 3), (2, 0), (2, 0)]
