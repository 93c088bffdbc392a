"""One key holding a third of all rows: results stay whole and exact."""

from pyspark.sql import functions as F

from quire.operators import crawl, tokenize
from quire.sources.pages import lookup_pages


def test_hot_token_vocab_and_encode(spark):
    rows = [(i, ("the " * 200 if i % 3 == 0 else f"word{i} other{i % 7} ") + "end") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    vocab = tokenize.fit_vocab(docs)
    top = vocab.orderBy("id").first()
    assert top.token == " the" and top.id == tokenize.FIRST_ID
    assert top["count"] == sum(r[1].count(" the") for r in rows)
    enc = tokenize.encode(docs, vocab, ["doc_id"])
    back = tokenize.decode(enc, vocab, ["doc_id"], "ids", "t").join(docs, "doc_id")
    assert back.count() == 300 and back.where(F.col("t") != F.col("text")).count() == 0


def test_hot_url_in_crawl_list(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "<article>" + ("w%d " % i) * 80 + "</article>")
                                   for i in range(30)], "page_id long, url string, html string")
    urls = spark.createDataFrame([(s, "http://h/0" if s % 3 == 0 else f"http://h/{s % 30}") for s in range(300)],
                                 "seq long, url string")
    got = lookup_pages(urls, pages)
    assert got.count() == 300 and got.where("page_id = 0").count() == 100
    vocab = tokenize.fit_vocab(crawl.clean_pages(pages).where("reject_reason IS NULL"), "text")
    chunks, rejects = crawl.crawl_pass(urls, pages, vocab, 16)
    per = {r.seq: r.n_chunks for r in crawl.report(chunks, urls).collect()}
    assert len(per) == 300 and all(v > 0 for v in per.values()) and rejects.count() == 0
