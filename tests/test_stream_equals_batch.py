from pyspark.sql import functions as F

from quire.operators import tokenize
from quire.plans import derived as D
from quire.streaming.jobs import run_page_chunks, run_padded_rows
from tests.conftest import SF_SMALL


def _chunks(df):
    return sorted((r.page_id, r.chunk_idx, tuple(r.input_ids)) for r in
                  df.select("page_id", "chunk_idx", "input_ids").collect())


def test_page_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    # pages arrive as several files
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    pages.repartition(3).write.parquet(str(src / "part"))
    vocab = tokenize.fit_vocab(D.kept_pages(spark, SF_SMALL), "text")
    out = str(tmp_path / "out")
    paths = run_page_chunks(spark, str(src / "part"), vocab, 64, out=out, max_files_per_trigger=1)
    streamed = spark.read.parquet(paths["chunks"])
    assert streamed.select("batch_id").distinct().count() == 3

    from quire.operators import chunking
    kept = D.kept_pages(spark, SF_SMALL)
    batch = chunking.chunk(tokenize.encode(kept, vocab, ["page_id"]).where(F.size("ids") >= 64), 64)
    assert _chunks(streamed) == _chunks(batch)

    # a restart from the same checkpoint finds no new file and writes nothing twice
    run_page_chunks(spark, str(src / "part"), vocab, 64, out=out, max_files_per_trigger=1)
    assert _chunks(spark.read.parquet(paths["chunks"])) == _chunks(batch)
    m = spark.read.parquet(paths["metrics"]).agg(F.sum("n_chunks")).first()[0]
    assert m == len(_chunks(batch))


def test_record_stream_equals_batch(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    src = tmp_path / "docs"
    docs.repartition(2).write.parquet(str(src))
    vocab = tokenize.fit_vocab(docs.select("doc_id", "text"))
    path = run_padded_rows(spark, str(src), vocab, 64, out=str(tmp_path / "o"))
    got = sorted((r.doc_id, tuple(r.input_ids)) for r in spark.read.parquet(path).collect())
    from quire.operators import chunking
    exp = chunking.pad(tokenize.encode(docs.select("doc_id", "text"), vocab, ["doc_id"]), 64, "ids")
    assert got == sorted((r.doc_id, tuple(r.input_ids)) for r in exp.collect())


def test_stream_cap_and_vocab_roundtrip(spark, tmp_path):
    from quire.operators.tokenize import load_vocab, save_vocab
    from quire.streaming.jobs import page_stream
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    pages.repartition(2).write.parquet(str(tmp_path / "p"))
    capped = page_stream(spark, str(tmp_path / "p"), max_docs=7)
    q = (capped.writeStream.format("memory").queryName("capped_pages")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("SELECT count(*) FROM capped_pages").first()[0] == 7
    v = tokenize.fit_vocab(D.kept_pages(spark, SF_SMALL), "text")
    save_vocab(v, str(tmp_path / "v"))
    assert sorted(load_vocab(spark, str(tmp_path / "v")).collect()) == sorted(v.collect())


def test_failed_url_is_skipped_in_later_batches(spark, tmp_path):
    """Three deliveries and restarts; the result is that of one batch pass over all of them."""
    from quire.operators import crawl
    long, short = "<article>" + "word " * 80 + "</article>", "<article>no</article>"
    few = "<article>" + "x" * 300 + "</article>"
    parts = [[(0, "u/ok", long), (1, "u/short", short), (2, "u/few", few), (3, "u/none", None), (4, "u/short", long)],
             [(10, "u/short", long), (11, "u/ok", long), (12, "u/new", short), (13, None, long)],
             [(20, "u/few", few), (21, "u/new", short), (22, "u/none", None), (23, "u/ok", long)]]
    vocab = tokenize.fit_vocab(spark.createDataFrame([("word word",)], "text string"))
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, part in enumerate(parts):
        spark.createDataFrame(part, "page_id long, url string, html string").coalesce(1).write.mode("append").parquet(src)
        paths = run_page_chunks(spark, src, vocab, 16, out=out)
        run_page_chunks(spark, src, vocab, 16, out=out)  # nothing new
    rejects = sorted((r.seq, r.url, r.reason) for r in spark.read.parquet(paths["rejects"]).collect())
    pages = spark.createDataFrame([p for part in parts for p in part if p[1]], "page_id long, url string, html string")
    chunks, bad = crawl.crawl_pass(pages.select(F.col("page_id").alias("seq"), "url"), pages, vocab, 16)
    assert rejects == sorted(map(tuple, bad.collect()))
    assert [r[0] for r in rejects if r[2] == "blocklisted"] == [4, 10, 20, 21, 22]
    got = spark.read.parquet(paths["chunks"])
    assert sorted((r.page_id, r.chunk_idx) for r in got.collect()) == sorted((r.seq, r.chunk_idx) for r in chunks.collect())
    log = spark.read.parquet(paths["log"])
    total = {r.tag: r.v for r in log.groupBy("tag").agg(F.sum("value").alias("v")).collect()}
    assert total == {"n_chunks": got.count(), "n_pages": 3, "n_rejects": len(rejects)}
    assert sorted((r.step, r.tag) for r in log.collect()) == sorted((i, t) for i in range(3) for t in total)


def test_metric_log_is_replaced_on_replay(spark, tmp_path):
    from quire.streaming.jobs import observed, write_metrics
    path = str(tmp_path / "log")
    for value in (3, 5):
        write_metrics(spark, path, "run", 7, {"loss": value, "none": None})
    write_metrics(spark, path, "run", 8, {"loss": 1})
    rows = sorted((r.run, r.step, r.tag, r.value) for r in spark.read.parquet(path).collect())
    assert rows == [("run", 7, "loss", 5.0), ("run", 7, "none", 0.0), ("run", 8, "loss", 1.0)]
    seen = observed(spark.range(9), {"n": F.count(F.lit(1)), "top": F.max("id")}, lambda df: df.write.parquet(str(tmp_path / "x")))
    assert seen == {"n": 9, "top": 8}


def test_stream_queries_read_a_table_of_part_files(spark, tmp_path):
    from quire.plans.queries import QUERIES
    good = "<html><body><article>" + "<p>some words of a page that is long enough</p>" * 30 + "</article></body></html>"
    pages = [(i, f"http://h.example/{i}", "<p>short</p>" if i == 3 else good) for i in range(6)]
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    docs = [(i, t, "en", "web", 0) for i, t in enumerate(["a b c", "", None, "d e"])]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(2).write.parquet(
        str(tmp_path / "documents.parquet"))
    got = {n: QUERIES[n](spark, str(tmp_path)) for n in ("stream_page_chunks", "stream_rejects", "stream_metric_log", "stream_padded_rows")}
    want = QUERIES["page_chunks"](spark, str(tmp_path))
    assert sorted(got["stream_page_chunks"].collect()) == sorted(want.select(*got["stream_page_chunks"].columns).collect())
    assert [tuple(r) for r in got["stream_rejects"].collect()] == [(3, "http://h.example/3", "short_text")]
    assert {r.tag: r.value for r in got["stream_metric_log"].collect()} == {"n_chunks": want.count(), "n_pages": 5, "n_rejects": 1}
    assert sorted(r.doc_id for r in got["stream_padded_rows"].collect()) == [0, 3]


def test_a_sink_without_rows_is_an_empty_table(spark, tmp_path):
    from quire.streaming.jobs import REJECT_SCHEMA, read_sink
    good = "<html><body><article>" + "<p>some words of a page that is long enough</p>" * 30 + "</article></body></html>"
    pages = spark.createDataFrame([(1, "http://h.example/1", good)], "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "src"))
    vocab = tokenize.fit_vocab(spark.createDataFrame([("some words",)], "text string"))
    paths = run_page_chunks(spark, str(tmp_path / "src"), vocab, 64, out=str(tmp_path / "out"))
    assert read_sink(spark, paths["rejects"], REJECT_SCHEMA).count() == 0
    assert spark.read.parquet(paths["chunks"]).count() > 0


def test_urls_of_one_state_key_are_judged_one_by_one():
    import pandas as pd

    from quire.streaming.jobs import FailedUrls

    class Failed(dict):
        def exists(self):
            return bool(self)

        def containsKey(self, k):
            return k in self

        def updateValue(self, k, v):
            self[k] = v

    class Handle:
        def getMapState(self, *_):
            return kept

    def batch(*parts):
        cols = ["page_id", "url", "text", "why"]
        out = p.handleInputRows((0,), iter([pd.DataFrame(rows, columns=cols).assign(part=0) for rows in parts]), None)
        return [(r.page_id, r.url, r.known) for pdf in out for r in pdf.itertuples()]

    kept, p = Failed(), FailedUrls()
    p.init(Handle())
    # of the rows of one URL, in whatever part, the smallest page speaks for it
    assert not any(k for _, _, k in batch([(5, "a", "t", "short_text"), (2, "b", "t", None)], [(1, "a", "t", None), (7, "b", "t", "x"), (3, "c", "t", "y")]))
    assert kept == {("c",): ("y",)}
    assert batch([(9, "c", "t", None), (4, "d", None, "fetch_failed"), (6, "a", "t", "x")]) == [(9, "c", True), (4, "d", False), (6, "a", False)]
    assert kept == {("c",): ("y",), ("d",): ("fetch_failed",), ("a",): ("x",)}


def test_a_batch_does_not_begin_anew(spark, tmp_path, monkeypatch):
    """The vocabulary's dictionary is made once for all batches, a file is parsed by several tasks, the session's settings come back."""
    import pytest

    from quire.operators import lookup
    from quire.streaming.jobs import STATE_CONF, at_once, judged_pages, page_stream
    good = "<article>" + "word " * 80 + "</article>"
    spark.createDataFrame([(i, f"u/{i}", good) for i in range(6)], "page_id long, url string, html string").repartition(3).write.parquet(
        str(tmp_path / "in"))
    vocab = tokenize.fit_vocab(spark.createDataFrame([("word word",)], "text string"))
    made, plain = [], lookup.dictionary_end
    monkeypatch.setattr(lookup, "dictionary_end", lambda *a: made.append(1) or plain(*a))
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    paths = run_page_chunks(spark, str(tmp_path / "in"), vocab, 16, out=str(tmp_path / "out"), max_files_per_trigger=1)
    got = spark.read.parquet(paths["chunks"])
    assert got.select("batch_id").distinct().count() == 3 and got.count() == 6 * 5
    assert len(made) == 1 and before == {k: spark.conf.get(k, None) for k in STATE_CONF}
    plan = judged_pages(page_stream(spark, str(tmp_path / "in")), 16)._jdf.queryExecution().analyzed().toString()
    assert f"], {spark.sparkContext.defaultParallelism}" in plan[plan.index("RepartitionByExpression"):].split("\n")[0]
    ran = []
    with pytest.raises(ZeroDivisionError):
        at_once(spark, lambda: 1 / 0, lambda: ran.append(spark.range(3).count()))
    assert ran == [3] and at_once(spark, lambda: 1, lambda: 2) == [1, 2]
