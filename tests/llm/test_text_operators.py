"""Chat, URL filter, codec, packing, toxicity and HTML extraction on odd inputs."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
from quire.llm import bpe_codec, chat, packing, site_tree, toxicity, url_filter
from tests.conftest import SF_SMALL

TEXTS = [None, "", " ", "\n", "plain words here", "It's  two  blanks\t\n and\r\nlines ", "naïve café ÀÉ×÷ ñandú ß",
         "日本語のテキスト です。　全角", "a\u00a0b\u2003c\u3000d e\u0301", "x<|endoftext|> y<|startoftext|>z <|end", "don't WE'LL 'S 12345 6.7",
         "q" * 3000, "ab " * 2000, "😀 emoji 👩‍👩‍👧 mix\x00\x1f", "plain words here", "| a | b |", "ǅ İ ſ µ ª º ½"]


def _docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")


def test_codec_equals_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    coded = bpe_codec.encode(_docs(spark), path, ids_col="coded")
    rows = {r.doc_id: r for r in bpe_codec.decode(coded, path, ids_col="coded").collect()}
    for i, t in enumerate(TEXTS):
        want = tok.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(rows[i].coded, "<u4").tolist() == want, TEXTS[i]
        assert rows[i].decoded == (t or "")
    assert bpe_codec.encode(_docs(spark).filter("false"), path).count() == 0


def test_long_fragments_merge_like_short_ones():
    bpe = bpe_codec.ForcedBoundaryBPE(bpe_codec.read_spec(public_tokenizers.path("byte_bpe_50k.json")))
    for piece in ("aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "internationalizationinternationalization"):
        assert bpe._merge_long([bpe.vocab[c] for c in piece]) == bpe._plain(piece) or len(bpe.fragments(piece)) > 1
        assert "".join(bpe.fragments(piece)) == piece


def _check_packing(rows, ids, window):
    assert {r.doc_id for r in rows} == set(ids)
    for d, own in ids.items():
        at = 0
        for r in sorted((r for r in rows if r.doc_id == d), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(own)
            assert r.ids_crc32 == zlib.crc32(own[at:at + r.length].tobytes())
            at += r.length
        assert at == len(own)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return by


def test_packing(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    ids = {i: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in enumerate(TEXTS)}
    rows = packing.pack(_docs(spark).repartition(7), path, window=64, open_windows=3, min_piece=4, fan_in=2).collect()
    by = _check_packing(rows, ids, 64)
    assert len(by) <= 1.1 * sum(map(len, ids.values())) / 64 + 1
    assert packing.pack(_docs(spark).filter("false"), path).count() == 0


def test_chat_round_trip(spark):
    nasty = "</s><sep><s>assistant\n&lt;&amp; \\ x"
    rows = [(1, 0, "user", "hi"), (1, 1, "user", nasty), (1, 2, "assistant", nasty), (1, 3, "assistant", None),
            (2, 0, None, "no role"), (2, None, "a\n<b", ""), (None, 0, "assistant", "😀z"), (3, 5, "assistant", "t"), (3, 5, "assistant", "t")]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(turns)).collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", "hi"), ("user", nasty), ("assistant", nasty), ("assistant", "")]
    assert got[1].loss_text == nasty and got[1].formatted.count("<s>") == 2
    assert [tuple(t) for t in got[2].turns] == [("a\n<b", ""), ("", "no role")]
    assert got[None].loss_text == "😀z" and got[3].loss_text == "tt"
    assert chat.format_chats(turns.filter("false")).count() == 0


def test_bloom_filter_never_misses_and_join_is_exact(spark):
    urls = [f"https://www.H{i}.example.net/p{i}/?q#f" for i in range(2000)] + [None, "no scheme", "x://", "http://a.org?x", "HTTP://B.COM/fr/1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit(0))
    listed = spark.createDataFrame([(f"h{i}.example.net/p{i}",) for i in range(0, 2000, 3)], "canon string")
    for most in (1, 1 << 15):  # a filter that is far too small lets more through, and changes nothing
        got = {r.page_id: r for r in url_filter.judge_urls(pages, listed, max_blocks=most).collect()}
        assert [i for i in range(2000) if got[i].verdict == "block"] == list(range(0, 2000, 3))
    assert (got[2000].host, got[2000].path, got[2000].rule, got[2000].verdict) == ("", "", None, "allow")
    assert got[2003].rule is None and got[2003].host == "a.org" and got[2004].rule == "com/fr/"
    assert url_filter.judge_urls(pages, listed.filter("false")).filter("listed").count() == 0


def test_toxicity_small(spark):
    docs = spark.createDataFrame([(i, ("you idiot moron " if i % 3 == 0 else "the fine day ") * 5 + f"w{i}") for i in range(200)]
                                 + [(900, None), (901, ""), (None, "you idiot"), (0, "the fine day")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(200)] + [(None, 0, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.fit(docs, labels).score(docs, ["doc_id"]).collect()
    assert len(rows) == 204 and all(0 <= r.score <= 1 for r in rows)
    assert all((r.score >= 0.5) == (r.doc_id % 3 == 0) for r in rows if r.doc_id and r.doc_id < 200)
    plain = toxicity.fit(docs, labels.filter("toxic = 0")).score(docs, ["doc_id"]).collect()
    assert len(plain) == 204
    got = {r.doc_id: r.h for r in docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h")).collect() if r.doc_id is not None}
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in got.items())


def _page(i, body, extra=""):
    return (i, "https://s.example.net/p", f"<html><head><title>t</title><script>if (a<b) x('</p>')</script></head><body><nav><a href='/'>Home</a></nav>"
            f"<div>Read our great magazine every day</div><div><p>{body}</p></div>{extra}<footer>&copy; s</footer></body></html>")


def test_site_tree_cuts_repeated_branches(spark):
    rows = [_page(i, f"Body number {i} caf&eacute; &amp; <b>bold</b>{i}<br>next &lt;tag&gt;") for i in range(20)]
    rows += [(50, "https://one.example.net/", "<article><h1>T</h1><p><b>open<br><p>two</article><div class='ad'>buy</div><div class=\"comments\"><p>me too</p></div>"),
             (51, None, "<p>x <!-- c --> y"), (52, "https://one.example.net/", None), (53, "u", ""), (54, "u", "<p>a &am"), (50, "u", "plain")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, host int").repartition(3)
    got = {}
    for r in site_tree.extract(pages).collect():
        got.setdefault(r.page_id, []).append(r.text)
    assert got[7] == ["Body number 7 café & bold7 next <tag>"]
    assert sorted(got[50]) == ["T open two", "plain"] and got[51] == ["x y"] and got[52] == [""] and got[53] == [""] and got[54] == ["a &am"]
    assert site_tree.extract(pages.filter("false")).count() == 0


def test_site_tree_keeps_text_in_wrappers_with_noise_words(spark):
    story = lambda i: f"story {i} " + " ".join(f"w{i}x{k}" for k in range(40))
    wraps = ["<div class='content has-sidebar'>%s</div>", "<div id='search-and-main'>%s</div>", "<form>%s</form>",
             "<div class='sidebar'><main>%s</main></div>", "<div class='page-with-nav'><article>%s</article></div>"]
    rows = [(100 * h + i, f"http://h{h}.example/{i}", "<body><div class='article-header'><h1>" + f"title {h} {i}</h1></div>"
             + wrap % f"<p>{story(i)}</p>" + "<div class='ad'>buy now</div><div class='site-footer'>the same line</div>"
             f"<form>search {i}</form></body>") for h, wrap in enumerate(wraps) for i in range(12)]
    got = {r.page_id: r.text for r in site_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {100 * h + i: f"title {h} {i} {story(i)}" for h in range(len(wraps)) for i in range(12)}


@pytest.mark.parametrize("name", ["op1_chat_format", "op10_url_filter"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(map(repr, res.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*cols).collect())


def test_codec_query_digests(spark):
    rows = E.queries()["op8_bpe_codec"](spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in rows[:40]:
        ids = tok.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
