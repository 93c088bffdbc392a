"""Structured Streaming forms of the crawl and record jobs.

Pages or records arrive as files; each micro-batch is processed with the same
batch operators inside ``foreachBatch`` (encode regroups rows, which a plain
streaming plan could only do with a watermark).  Sinks are Parquet folders
partitioned by ``batch_id``; a batch re-run after a failure overwrites its own
partition, so the output is exactly-once.  The failed-URL set (T3) is keyed state in the state
store: it says whether a URL has failed in an earlier batch, and is recovered with the stream.
Metrics of a batch are observed while it is written, not read back from the sink.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.util import inheritable_thread_target

from quire.operators import chunking, crawl, tokenize
from quire.operators.indexing import write_table
from quire.operators.tokenize import PAD_ID
from quire.session import scratch_path

PAGE_SCHEMA = "page_id bigint, url string, html string"
# What the sinks hold.
CHUNK_SCHEMA = "page_id long, url string, chunk_idx int, start int, input_ids array<int>, attention_mask array<int>"
REJECT_SCHEMA = "seq long, url string, reason string"
LOG_SCHEMA = "run string, tag string, step long, value double"
ROW_SCHEMA = "doc_id long, attention_mask array<int>, input_ids array<int>"
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_id").parquet(path))


def observed(df: DataFrame, metrics: dict, write) -> dict:
    """Runs ``write(df)`` and returns the ``metrics`` (name -> aggregate) of the rows that went through."""
    seen = Observation()
    write(df.observe(seen, *(c.alias(k) for k, c in metrics.items())))
    return {k: seen.get[k] for k in metrics}


def write_metrics(spark: SparkSession, path: str, run: str, step: int, values: dict) -> None:
    """Metric log rows (run, tag, step, value) of one batch; the same batch written again replaces them."""
    rows = [(run, k, step, float(v or 0)) for k, v in values.items()]
    _write_batch(spark.createDataFrame(rows, LOG_SCHEMA), path, step)


def at_once(spark: SparkSession, *jobs) -> list:
    """The results of ``jobs``, which do not need each other and run beside each other; the first failure is raised when all have ended."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in started]


#: Groups of URLs (by hash) that share a key of the state; part of a checkpoint, so it is the same in every run.
GROUPS = 1 << 9


class FailedUrls(StatefulProcessor):
    """Keyed state of a group of URLs: the reason of the first failure of each.  Rows pass through with ``known``: the URL failed in
    an earlier batch.

    Of the rows of one batch the page of smallest id speaks for the URL.  Rows are not gathered; a group shares the cost of a call."""

    def init(self, handle) -> None:
        self.failed = handle.getMapState("failed", "url string", "reason string")

    def handleInputRows(self, key, rows, timerValues):
        some, known, first = self.failed.exists(), {}, {}
        for pdf in rows:
            urls = pdf["url"].tolist()
            for url, page, why in zip(urls, pdf["page_id"].tolist(), pdf["why"].tolist(), strict=True):
                if url not in known:
                    known[url] = some and self.failed.containsKey((url,))
                if url not in first or page < first[url][0]:
                    first[url] = page, why
            yield pdf.drop(columns="part").assign(known=[known[u] for u in urls])
        for url, (_, why) in first.items():
            if not known[url] and isinstance(why, str):
                self.failed.updateValue((url,), (why,))

    def close(self) -> None:
        pass


#: The state store: RocksDB; a batch adds its changes to the checkpoint, not the files of the whole store.
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
              "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def judged_pages(pages: DataFrame, L: int) -> DataFrame:
    """A page stream as page_id, url, text, why (it fails by itself), known (its URL failed in an earlier batch).

    Pages without a URL or an id are left out: nothing could name them."""
    ids = F.size(tokenize.pretoken_array("text"))  # a pre-token is an id
    # a batch may be one file, which is one task's to read; not all of it is one task's to parse
    tasks = pages.sparkSession.sparkContext.defaultParallelism
    rows = crawl.clean_pages(pages.where("url IS NOT NULL AND page_id IS NOT NULL").repartition(tasks, "page_id", "url")).select(
        "page_id", "url", "text", F.coalesce("reject_reason", F.when(ids < L, F.lit(crawl.REASON_FEW_TOKENS))).alias("why"))
    return rows.withColumn("part", F.pmod(F.xxhash64("url"), F.lit(GROUPS))).groupBy("part").transformWithStateInPandas(
        FailedUrls(), "page_id bigint, url string, text string, why string, known boolean", "Append", "None")


def file_stream(spark: SparkSession, source: str, schema: str, files: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files arriving in folder ``source`` (names matching ``files``, if given: files, or folders of part files)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    # as a pattern, even of one name: only a pattern may match a file as well as a folder
    return r.parquet(f"{source.rstrip('/')}/{{{files}}}" if files else source)


def read_sink(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A sink read back; one that no batch has written a row to is an empty table."""
    _write_batch(spark.createDataFrame([], schema), path, -1)  # names the folder, replaces nothing
    return spark.read.schema(f"{schema}, batch_id long").parquet(path)


def page_stream(spark: SparkSession, source: str, files: str | None = None,
                max_files_per_trigger: int | None = None, max_docs: int | None = None) -> DataFrame:
    """Pages as a stream (``maxFilesPerTrigger`` paces it; ``max_docs`` caps it)."""
    s = file_stream(spark, source, PAGE_SCHEMA, files, max_files_per_trigger)
    return s.limit(int(max_docs)) if max_docs else s


def run_page_chunks(spark: SparkSession, source: str, vocab: DataFrame, L: int = 64,
                    out: str | None = None, files: str | None = None,
                    max_files_per_trigger: int | None = None,
                    max_docs: int | None = None) -> dict:
    """Stream pages -> article text -> ids -> windows, with blocklist,
    rejects and a metric log.  Runs to completion (``availableNow``).

    The stream is one pass: a URL that has failed, in this batch or an earlier one, is ``blocklisted`` when it comes again.
    Returns the folder names: chunks, rejects, metrics (counts of each batch), log (run, tag, step, value).
    """
    base = out or scratch_path(spark, "page-chunks")
    paths = {k: f"{base}/{k}" for k in ("chunks", "rejects", "metrics", "log")}
    vocab = vocab.persist()
    made = tokenize.dictionary(vocab)  # once, not in every batch

    def each(batch: DataFrame, batch_id: int):
        sp = batch.sparkSession
        # one action on the stateful plan: everything below reads the written rows
        rows = write_table(batch, "stream-batch")
        fresh = rows.where("NOT known")
        pages = fresh.select("page_id", "url", "text", F.when(F.col("why") != crawl.REASON_FEW_TOKENS, F.col("why")).alias("reject_reason"))
        chunks, rejects = crawl.crawl_pass(fresh.select(F.col("page_id").alias("seq"), "url"), pages, vocab, L, made=made)
        rejects = rejects.unionByName(rows.where("known").select(
            F.col("page_id").alias("seq"), "url", F.lit(crawl.REASON_BLOCKED).alias("reason")))
        chunks = chunks.select(F.col("seq").alias("page_id"), "url", "chunk_idx", "start", "input_ids", "attention_mask")
        done = at_once(
            sp, lambda: observed(chunks, {"n_chunks": F.count(F.lit(1)), "n_pages": F.count_if(F.col("chunk_idx") == 0)},
                                 lambda df: _write_batch(df, paths["chunks"], batch_id)),
            lambda: observed(rejects, {"n_rejects": F.count(F.lit(1))}, lambda df: _write_batch(df, paths["rejects"], batch_id)))
        done = done[0] | done[1]
        counts = sp.createDataFrame([(done["n_chunks"], done["n_pages"])], "n_chunks long, n_pages long")
        at_once(sp, lambda: _write_batch(counts, paths["metrics"], batch_id),
                lambda: write_metrics(sp, paths["log"], base.rstrip("/").rsplit("/", 1)[-1], batch_id, done))

    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        pages = page_stream(spark, source, files, max_files_per_trigger, max_docs)
        q = (judged_pages(pages, L).writeStream.outputMode("append")
             .foreachBatch(each).option("checkpointLocation", f"{base}/_checkpoint")
             .trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    q.awaitTermination()
    vocab.unpersist()
    return paths


def run_padded_rows(spark: SparkSession, source: str, vocab: DataFrame, L: int = 64,
                    out: str | None = None, files: str | None = None,
                    max_files_per_trigger: int | None = None) -> str:
    """Stream records -> drop null/'' -> ids -> truncate/pad to L with masks."""
    base = out or scratch_path(spark, "padded-rows")
    path = f"{base}/rows"
    vocab = vocab.persist()

    def each(batch: DataFrame, batch_id: int):
        recs = batch.where(F.col("text").isNotNull() & (F.col("text") != "")).select("doc_id", "text")
        enc = tokenize.encode(recs, vocab, ["doc_id"], "text", "ids")
        _write_batch(chunking.pad(enc, L, "ids", PAD_ID), path, batch_id)

    q = (file_stream(spark, source, DOC_SCHEMA, files, max_files_per_trigger).writeStream.foreachBatch(each)
         .option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    vocab.unpersist()
    return path
