"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Id sequences are rendered as space-separated strings in the outputs (the
operators themselves keep ``array<int>``), and doubles are rounded to 6
decimals, so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import arrays as A
from quire.functions.text import single_line
from quire.operators import batching, chunking, crawl, metrics, runs, sampling, tokenize
from quire.plans import derived as D
from quire.session import bound_batches, checkpoint_dir, ship_package
from quire.sources.corpus import nonempty_records, read_articles, table
from quire.sources.lines import repeat_lines, with_row_id

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            checkpoint_dir(spark)
            bound_batches(spark)
            ship_package(spark)
            return fn(spark, sf)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def _r6(c):
    return F.round(c, 6)


# --------------------------------------------------------------------------- pages

@register("page_text")
def q_page_text(spark, sf):
    """Visible text of every page without script and style."""
    return D.plain_pages(spark, sf).select("page_id", "text")


@register("article_text_kept")
def q_article_text_kept(spark, sf):
    """Article profile, kept iff longer than 200 characters."""
    return D.kept_pages(spark, sf).select("page_id", "url", "text",
                                         F.length("text").cast("long").alias("n_chars"))


@register("crawl_corpus_lines")
def q_crawl_corpus_lines(spark, sf):
    """URL list -> stored page -> plain text -> one line per non-empty page."""
    urls = D.url_list(spark, sf)
    pages = table(spark, sf, "pages")
    from quire.sources.pages import lookup_pages
    from quire.functions.html import page_text
    got = lookup_pages(urls, pages).select("seq", "url", page_text("html").alias("text"))
    return got.where(F.col("text").isNotNull() & (F.col("text") != "")).select(
        "seq", single_line("text").alias("line"))


@register("page_chunks")
def q_page_chunks(spark, sf):
    """Flagship (T1 batch twin): kept pages -> fitted vocabulary -> ids -> >= L -> windows of L.

    The cleaned pages feed both the vocabulary fit and the encode, so they are
    written once (HTML parsing is the most expensive step) and read twice.
    """
    from quire.operators.indexing import write_table
    kept = write_table(D.kept_pages(spark, sf), "kept-pages")
    vocab = tokenize.fit_vocab(kept, "text")
    enc = tokenize.encode(kept, vocab, ["page_id"], "text", "ids")
    ch = chunking.chunk(enc.where(F.size("ids") >= D.L_PAGE), D.L_PAGE, "ids")
    return ch.select("page_id", "url", F.col("chunk_idx").cast("int").alias("chunk_idx"),
                     F.col("start").cast("int").alias("start"),
                     A.ids_text("input_ids").alias("input_ids"),
                     F.size("attention_mask").cast("int").alias("mask_len"))


def _crawled(spark, sf, L=D.L_PAGE):
    """(URL list, chunks, rejects) of a full pass; the stored pages are parsed once, for the vocabulary and the pass."""
    urls = D.url_list(spark, sf)
    stored = crawl.clean_stored(table(spark, sf, "pages"))
    vocab = tokenize.fit_vocab(stored.where(F.col("reject_reason").isNull()), "text")
    return urls, *crawl.crawl_pass(urls, stored, vocab, L)


@register("chunks_per_url")
def q_chunks_per_url(spark, sf):
    """A5: chunks per URL of the crawl list (0 when rejected), full crawl pass."""
    urls, chunks, _ = _crawled(spark, sf)
    return crawl.report(chunks, urls)


@register("crawl_rejects")
def q_crawl_rejects(spark, sf):
    """Rejected URLs with the reason (fetch failed, short text, few tokens; blocklisted after the first failure)."""
    return _crawled(spark, sf)[2]


@register("crawl_rejects_long")
def q_crawl_rejects_long(spark, sf):
    """the pass with windows of 512 ids, which many kept pages are too short for."""
    return _crawled(spark, sf, 512)[2]


@register("crawl_summary")
def q_crawl_summary(spark, sf):
    """A5: successful URLs, chunk total and the zero-success flag of one pass."""
    urls, chunks, _ = _crawled(spark, sf)
    return crawl.summary(crawl.report(chunks, urls))


@register("skip_blocklist")
def q_skip_blocklist(spark, sf):
    """Second pass skips URLs blocklisted by the first; returns the URLs still crawled."""
    urls, _, rejects = _crawled(spark, sf)
    block = crawl.blocklist_from(rejects)
    return crawl.skip_blocklist(urls, block).select("seq", "url")


# --------------------------------------------------------------------------- lines / records

@register("corpus_lines")
def q_corpus_lines(spark, sf):
    """Texts as line files: split, Unicode strip, blanks dropped."""
    return D.doc_lines(spark, sf)


@register("saved_lines")
def q_saved_lines(spark, sf):
    """Page texts saved as a line file, one line a page, and read back; lines counted, for a file has no keys."""
    from quire.session import scratch_path
    from quire.sources.lines import read_lines, write_lines
    path = scratch_path(spark, "saved-lines")
    write_lines(D.plain_pages(spark, sf), path)
    return read_lines(spark, path).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@register("repeat_lines")
def q_repeat_lines(spark, sf):
    """Dense line ids over all corpus lines, then every line 100 times, order kept."""
    lines = with_row_id(D.doc_lines(spark, sf), ["doc_id", "pos"], "line_pos")
    return repeat_lines(lines, 100, "line_pos", "text")


@register("nonempty_records")
def q_nonempty_records(spark, sf):
    """record streams keep every text that is neither null nor ''."""
    conv = table(spark, sf, "conversations").select(
        F.lit("conversation").alias("kind"), F.col("conv_id").alias("rec_id"), "turn", "text")
    docs = table(spark, sf, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("rec_id"), F.lit(0).cast("long").alias("turn"), "text")
    return nonempty_records(conv.unionByName(docs))


@register("nonempty_derived")
def q_nonempty_derived(spark, sf):
    """records whose text is missing in one language and empty in another; only white space is kept."""
    lang = F.col("lang")
    docs = table(spark, sf, "documents").select("doc_id", "lang", F.when(lang == "de", F.lit(None)).when(lang == "fr", "").when(
        lang == "es", " ").otherwise(F.col("text")).alias("text"))
    return nonempty_records(docs).select("doc_id", "lang", F.length("text").cast("long").alias("n_chars"))


# --------------------------------------------------------------------------- tokens

@register("pretokens")
def q_pretokens(spark, sf):
    """P6 (split): one row per pre-token with its 0-based position."""
    return tokenize.pretokens(D.documents(spark, sf), ["doc_id"], "text").select(
        "doc_id", F.col("pos").cast("long").alias("pos"), "token")


@register("vocab")
def q_vocab(spark, sf):
    """Corpus vocabulary ranked by (count desc, token asc), ids from 2."""
    return D.doc_vocab(spark, sf)


@register("encoded_docs")
def q_encoded_docs(spark, sf):
    """Every document as token ids."""
    enc = D.encoded_docs(spark, sf)
    return enc.select("doc_id", F.size("ids").cast("long").alias("n_ids"), A.ids_text("ids").alias("ids"))


@register("decode_roundtrip")
def q_decode_roundtrip(spark, sf):
    """Ids back to text; equals the source text for a full vocabulary."""
    vocab = D.doc_vocab(spark, sf)
    enc = D.encoded_docs(spark, sf, vocab)
    dec = tokenize.decode(enc, vocab, ["doc_id"], "ids", "decoded")
    src = D.documents(spark, sf)
    return dec.join(src, "doc_id").select("doc_id", F.col("decoded").alias("text"),
                                          (F.col("decoded") == F.col("text")).alias("same"))


@register("given_vocab_ids")
def q_given_vocab_ids(spark, sf):
    """Documents under a stored vocabulary of other texts: unknown ids, and a decode that drops them."""
    vocab = D.given_vocab(spark, sf)
    enc = tokenize.encode(D.documents(spark, sf), vocab, text_col="text", out_col="ids").withColumn("own", F.col("ids"))
    dec = tokenize.decode(enc, vocab, ids_col="own", out_col="decoded")
    return dec.select("doc_id", F.size("ids").cast("long").alias("n_ids"),
                      F.size(F.filter("ids", lambda x: x == tokenize.UNK_ID)).cast("long").alias("n_unknown"),
                      A.ids_text("ids").alias("ids"), "decoded")


@register("given_vocab_pieces")
def q_given_vocab_pieces(spark, sf):
    """Unknown pre-tokens split into the longest tokens of the stored vocabulary that they begin with."""
    vocab = D.given_vocab(spark, sf)
    enc = tokenize.encode(D.documents(spark, sf), vocab, text_col="text", out_col="ids", fallback=tokenize.prefix_pieces(vocab))
    return enc.select("doc_id", F.size("ids").cast("long").alias("n_ids"),
                      F.size(F.filter("ids", lambda x: x == tokenize.UNK_ID)).cast("long").alias("n_unknown"),
                      A.ids_text("ids").alias("ids"))


@register("padded_loss")
def q_padded_loss(spark, sf):
    """Loss of padded rows under a stored vocabulary, labels that are padding left out (add-one corpus frequencies)."""
    vocab = D.given_vocab(spark, sf)
    enc = tokenize.encode(D.documents(spark, sf), vocab, text_col="text", out_col="ids", max_tokens=256)
    toks = chunking.shift(chunking.pad(enc, 256, "ids")).select("doc_id", F.explode("labels").alias("label"))
    total = vocab.agg(F.sum(F.col("count") + 1)).first()[0] or 0
    # unknown and padding are ids of their own, with a count of nothing
    counts = vocab.select("id", "count").unionByName(
        spark.createDataFrame([(tokenize.PAD_ID, 0), (tokenize.UNK_ID, 0)], "id int, count long"))
    per_id = counts.select("id", (-F.log((F.col("count") + 1) / F.lit(float(total + 2)))).alias("nll"))
    b = metrics.batch_loss(tokenize.lookup_ids(toks, per_id, "label"), ["doc_id"], "nll", "label")
    return b.select("doc_id", _r6("loss").alias("loss"), F.col("n_tokens").cast("long"))


@register("padded_rows")
def q_padded_rows(spark, sf):
    """Ids truncated / right-padded with eos to 64, real-token mask."""
    enc = D.encoded_docs(spark, sf)
    p = chunking.pad(enc, 64, "ids")
    return p.select("doc_id", A.ids_text("input_ids").alias("input_ids"),
                    A.ids_text("attention_mask").alias("attention_mask"))


@register("attention_mask")
def q_attention_mask(spark, sf):
    """real/pad mask vs the mask derived from ``id != pad`` on padded rows."""
    enc = D.encoded_docs(spark, sf)
    p = chunking.pad(enc, 64, "ids")
    nn = A.not_pad_mask("input_ids", tokenize.PAD_ID)
    return p.select("doc_id",
                    F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("long").alias("n_real"),
                    F.aggregate(nn, F.lit(0), lambda a, x: a + x).cast("long").alias("n_not_pad"),
                    A.ids_text(nn).alias("mask_not_pad"))


@register("shifted_pairs")
def q_shifted_pairs(spark, sf):
    """P10: decoder inputs/mask without the last position, labels without the first."""
    enc = D.encoded_docs(spark, sf)
    s = chunking.shift(chunking.pad(enc, 64, "ids"))
    return s.select("doc_id", A.ids_text("dec_input_ids").alias("dec_input_ids"),
                    A.ids_text("dec_attention_mask").alias("dec_attention_mask"),
                    A.ids_text("labels").alias("labels"))


@register("article_chunks")
def q_article_chunks(spark, sf):
    """All articles, whole, in windows of L=256."""
    docs = read_articles(D.documents(spark, sf), "doc_id")
    vocab = D.doc_vocab(spark, sf)
    enc = tokenize.encode(docs, vocab, ["doc_id"], "text", "ids")
    ch = chunking.article_chunks(enc, D.L_ARTICLE, "ids")
    return ch.select("doc_id", F.col("chunk_idx").cast("int").alias("chunk_idx"),
                     F.col("start").cast("int").alias("start"), A.ids_text("input_ids").alias("input_ids"))


@register("sql_chunks")
def q_sql_chunks(spark, sf):
    """Windows of 64 ids by the SQL table function, called for every document."""
    from quire.functions.sql import register_sql_functions
    register_sql_functions(spark)
    D.encoded_docs(spark, sf).createOrReplaceTempView("quire_encoded_docs")
    return spark.sql("""SELECT d.doc_id, c.chunk_idx, c.start, array_join(c.input_ids, ' ') AS input_ids
                        FROM quire_encoded_docs d, LATERAL chunk_ids(d.ids, 64) c""")


@register("capped_articles")
def q_capped_articles(spark, sf):
    """The first 150 articles, 512 ids of each at most (cut before any lookup), in windows of 64."""
    docs = read_articles(D.documents(spark, sf), "doc_id", 150)
    enc = tokenize.encode(docs, D.doc_vocab(spark, sf), text_col="text", out_col="ids", max_tokens=512)
    ch = chunking.chunk(enc, 64, "ids")
    return ch.select("doc_id", F.col("chunk_idx").cast("int").alias("chunk_idx"), A.ids_text("input_ids").alias("input_ids"))


@register("named_corpus")
def q_named_corpus(spark, sf):
    """S3: documents stored as name / config / split, one configuration and split of them read back with its partitions."""
    from quire.session import scratch_path
    from quire.sources.corpus import read_corpus, write_corpus
    root = scratch_path(spark, "corpora")
    docs = table(spark, sf, "documents").select("doc_id", "text", F.col("source").alias("name"), F.col("lang").alias("config"),
                                                F.when(F.col("doc_id") % 7 == 0, "test").otherwise("train").alias("split"))
    write_corpus(docs, root)
    first = docs.agg(F.min("name")).first()[0]
    return read_corpus(spark, root, first, "en", "train").select("doc_id", "name", "config", "split", F.length("text").cast("long").alias("n_chars"))


@register("cut_at_eos")
def q_cut_at_eos(spark, sf):
    """First 8 ids as prompt, generated part cut after the first id 2 (as eos), budget 56."""
    enc = D.encoded_docs(spark, sf)
    budget = sampling.budget(F.lit(8), 64)
    cut = sampling.cut_at_eos("ids", 8, budget, eos_id=2)
    return enc.select("doc_id", A.ids_text(cut).alias("ids"), F.size(cut).cast("long").alias("n_ids"))


# --------------------------------------------------------------------------- batches

def _batched(spark, sf):
    docs = D.documents(spark, sf).select("doc_id")
    sh = batching.shuffle(docs, ["doc_id"], D.SEED, 1)
    return batching.assign(sh, ["shuffle_key", "doc_id"], D.BATCH_SIZE)


@register("shuffled_order")
def q_shuffled_order(spark, sf):
    """Reproducible per-epoch order (md5 of key, seed, epoch) and the dense position."""
    return _batched(spark, sf).select("doc_id", "shuffle_key", F.col("row_idx").cast("long").alias("row_idx"))


@register("batches")
def q_batches(spark, sf):
    """Batch of 32 in shuffled order; last batch may be short."""
    b = _batched(spark, sf)
    coll = batching.collect(b, ["doc_id"])
    return coll.select("batch_id", F.array_join(F.transform("rows", lambda r: r["doc_id"].cast("string")), " ").alias("doc_ids"),
                       F.size("rows").cast("long").alias("n_rows"))


@register("epoch_batches")
def q_epoch_batches(spark, sf):
    """Batches of token rows (ids and masks) over two epochs, each in its own order without a sort."""
    rows = chunking.pad(D.encoded_docs(spark, sf), 64, "ids")
    b = batching.epochs(rows, ["doc_id"], 2, D.BATCH_SIZE, D.SEED)
    out = batching.collect(b, ["doc_id", "input_ids", "attention_mask"], ["epoch", "batch_id"])
    joined = lambda c, of: F.array_join(F.transform("rows", lambda r: of(r[c])), " ")
    return out.select("epoch", "batch_id", F.size("rows").cast("long").alias("n_rows"),
                      joined("doc_id", lambda x: x.cast("string")).alias("doc_ids"),
                      F.md5(joined("input_ids", A.ids_text)).alias("ids_md5"),
                      F.aggregate("rows", F.lit(0).cast("long"), lambda n, r: n + F.aggregate(
                          r["attention_mask"], F.lit(0).cast("long"), lambda k, m: k + m)).alias("n_real"))


@register("batch_sizes")
def q_batch_sizes(spark, sf):
    return batching.batch_sizes(_batched(spark, sf))


# --------------------------------------------------------------------------- losses

def _nll(spark, sf):
    vocab = D.doc_vocab(spark, sf)
    enc = D.encoded_docs(spark, sf, vocab)
    toks = enc.select("doc_id", F.posexplode("ids").alias("pos", "label"))
    nll = D.unigram_nll(toks, vocab, "label")
    return nll.withColumn("chunk", (F.col("pos") / 64).cast("int"))


def _batch_losses(spark, sf):
    return metrics.batch_loss(_nll(spark, sf), ["doc_id", "chunk"], "nll", "label")


@register("token_nll")
def q_token_nll(spark, sf):
    """Cross-entropy of the label under the row's logits."""
    lg = metrics.with_token_nll(D.logits(spark, sf), "logits", "label", "nll")
    return lg.select("vec_id", _r6("nll").alias("nll"))


@register("batch_loss")
def q_batch_loss(spark, sf):
    """Mean loss per batch over non-pad labels."""
    b = _batch_losses(spark, sf)
    return b.select("doc_id", "chunk", _r6("loss").alias("loss"), F.col("n_tokens").cast("long"))


@register("evaluate")
def q_evaluate(spark, sf):
    """Mean of all batch means, perplexity."""
    e = metrics.evaluate(_batch_losses(spark, sf), ["doc_id", "chunk"], "loss")
    return e.select(_r6("eval_loss").alias("eval_loss"), _r6("perplexity").alias("perplexity"),
                    F.col("n_batches").cast("long"))


@register("epoch_loss")
def q_epoch_loss(spark, sf):
    """A3: mean of batch losses per group (a document's windows stand for one epoch)."""
    e = metrics.epoch_loss(_batch_losses(spark, sf), ["doc_id"])
    return e.select("doc_id", _r6("train_loss").alias("train_loss"), F.col("n_batches").cast("long"))


@register("running_loss")
def q_running_loss(spark, sf):
    """Running mean of batch losses in step order."""
    r = metrics.running_loss(_batch_losses(spark, sf), ["doc_id"], "chunk")
    return r.select("doc_id", "chunk", _r6("running_loss").alias("running_loss"))


# --------------------------------------------------------------------------- runs

@register("early_stop")
def q_early_stop(spark, sf):
    """Patience counter (3, delta 1e-3) per epoch and the stop flag; epochs after a stop dropped."""
    h = runs.early_stop(D.history(spark, sf), 3, 1e-3, truncate=True)
    return h.select("run", "epoch", "eval_loss", "counter", "stop")


@register("running_best")
def q_running_best(spark, sf):
    """Best loss before each epoch and whether the epoch is a new best."""
    h = runs.running_best(D.history(spark, sf))
    return h.select("run", "epoch", "best_before", "is_best")


@register("best_epoch")
def q_best_epoch(spark, sf):
    """A4: first epoch with the minimal finite loss per run."""
    return runs.best_epoch(D.history(spark, sf))


@register("lr_schedule")
def q_lr_schedule(spark, sf):
    """Lr * 0.95^(epoch-1) beside each history row."""
    h = runs.with_lr(D.history(spark, sf), 1e-4, 0.95)
    return h.select("run", "epoch", "train_loss", "eval_loss", F.round("lr", 12).alias("lr"))


@register("run_snapshots")
def q_run_snapshots(spark, sf):
    """K6: best and early-stop snapshot rows of every run (patience 3, delta 1e-3)."""
    return runs.snapshots(D.history(spark, sf), 3, 1e-3)


@register("list_runs")
def q_list_runs(spark, sf):
    """Names matching YYYY-MM-DD_HH-MM-SS, sorted."""
    return runs.list_runs(D.run_names(spark, sf))


@register("promote_best")
def q_promote_best(spark, sf):
    """K7: promote every run's best in start order; the last promotion of a name wins."""
    h = D.history(spark, sf)
    rr = runs.runs_from_history(h, D.MODEL_NAME)
    # the name format sorts chronologically, so the name itself is the request order
    requests = runs.list_runs(D.run_names(spark, sf)).withColumn("seq", F.col("run_time"))
    empty = spark.createDataFrame([], "model_name string, run_time string, epoch int, eval_loss double, path string")
    return runs.promote(empty, rr, requests, D.MODEL_NAME)


@register("resume_point")
def q_resume_point(spark, sf):
    """A resumed run starts after its best epoch."""
    return runs.resume_point(D.history(spark, sf))


@register("resumed_early_stop")
def q_resumed_early_stop(spark, sf):
    """Every run is stopped after its best epoch and resumed from the snapshot; the counters of both parts together."""
    h = runs.with_lr(D.history(spark, sf))
    snaps = runs.full_snapshots(h, _run_configs(h))
    best = snaps.where("kind = 'best'").select("run", F.col("epoch").alias("at"))
    part = h.join(best, "run", "left")
    first = runs.early_stop(part.where(F.col("epoch") <= F.col("at")).drop("at"))
    second = runs.resume(snaps, h)
    cols = ["run", "epoch", "eval_loss", "counter", "stop"]
    return first.select(*cols).unionByName(second.select(*cols))


def _run_configs(history):
    """A config of each run as JSON."""
    return history.select("run").distinct().select("run", runs.config_snapshot(F.create_map(
        F.lit("batch_size"), F.lit("32"), F.lit("run"), F.col("run").cast("string"))).alias("config"))


@register("full_snapshots")
def q_full_snapshots(spark, sf):
    """K4/K6: last best and early-stop snapshot of every run with histories (in millionths), rule state and config."""
    h = runs.with_lr(D.history(spark, sf))
    micro = lambda c: F.array_join(F.transform(c, lambda x: F.round(x * 1e6).cast("long").cast("string")), " ")
    return runs.full_snapshots(h, _run_configs(h)).select(
        "run", "kind", "epoch", micro("eval_loss_history").alias("eval_history"), micro("train_loss_history").alias("train_history"),
        F.size("lr_history").cast("long").alias("n_lr"), _r6("early_stop.best").alias("best"), F.col("early_stop.counter").alias("counter"),
        F.from_json("config", "map<string,string>")["run"].alias("config_run"))


@register("history_files")
def q_history_files(spark, sf):
    """K2/K3: histories written as one CSV folder per run and as JSON rows, read back and zipped."""
    from quire.session import scratch_path
    h = runs.with_lr(D.history(spark, sf))
    csv, js = scratch_path(spark, "history-csv"), scratch_path(spark, "history-json")
    runs.write_history(h, csv, "csv")
    runs.write_history(h, js, "json")
    c = runs.read_history(spark, csv, "epoch int, train_loss double, eval_loss double, lr double, run long")
    z = spark.read.schema("run long, train_loss array<double>, eval_loss array<double>, lr array<double>").json(js).select(
        "run", F.posexplode(runs.zip_histories(F.col("train_loss"), F.col("eval_loss"), F.col("lr"))).alias("i", "z"))
    z = z.select("run", (F.col("i") + 1).alias("epoch"), F.col("z")["eval_loss"].alias("json_eval"), F.col("z")["lr"].alias("json_lr"))
    return c.join(z, ["run", "epoch"], "full").select(
        F.col("run"), F.col("epoch").cast("int").alias("epoch"), _r6("train_loss").alias("train_loss"), _r6("eval_loss").alias("eval_loss"),
        _r6("json_eval").alias("json_eval"), (F.abs(F.col("lr") - F.col("json_lr")) < 1e-15).alias("same_lr"))


@register("registry_publish")
def q_registry_publish(spark, sf):
    """K7: a registry published twice and read back through its manifest."""
    from quire.session import scratch_path
    h = D.history(spark, sf)
    rr = runs.runs_from_history(h, D.MODEL_NAME)
    root = scratch_path(spark, "registry")
    empty = spark.createDataFrame([], "model_name string, run_time string, epoch int, eval_loss double, path string")
    names = runs.list_runs(D.run_names(spark, sf))
    for seq in (F.reverse("run_time"), F.col("run_time")):  # another request wins in the first version
        old = runs.published(spark, root)
        runs.publish(runs.promote(empty if old is None else old, rr, names.withColumn("seq", seq), D.MODEL_NAME), root)
    return runs.published(spark, root)


@register("config_merge")
def q_config_merge(spark, sf):
    """Defaults updated by each event's JSON properties (later wins)."""
    ev = table(spark, sf, "events").select("event_id", "props")
    base = F.create_map(F.lit("max_len"), F.lit("256"), F.lit("batch_size"), F.lit("32"), F.lit("k"), F.lit("0"))
    m = runs.merge_config(base, F.from_json("props", "map<string,string>"))
    return ev.select("event_id", m["k"].alias("k"), m["max_len"].alias("max_len"),
                     F.size(m).cast("long").alias("n_keys"))


@register("config_from_json")
def q_config_from_json(spark, sf):
    """Stored config when present (purchases), else the JSON argument."""
    ev = table(spark, sf, "events").select("event_id", "event_type", "props")
    stored = F.when(F.col("event_type") == "purchase", F.col("props"))
    arg = F.concat(F.lit('{"k": "arg-'), F.col("event_type"), F.lit('"}'))
    cfg = runs.resolve_config(stored, arg)
    return ev.select("event_id", cfg["k"].alias("k"))


# --------------------------------------------------------------------------- sampling

TEMPERATURE = 0.1


def _lg(spark, sf):
    return D.logits(spark, sf)


@register("softmax")
def q_softmax(spark, sf):
    """Probabilities of every token at temperature 0.1."""
    lg = _lg(spark, sf).withColumn("z", sampling.scale("logits", TEMPERATURE))
    p = sampling.with_softmax(lg, "z", "probs")
    return (p.select("vec_id", F.posexplode("probs").alias("token_id", "prob"))
              .select("vec_id", F.col("token_id").cast("int"), _r6("prob").alias("prob")))


@register("greedy")
def q_greedy(spark, sf):
    """Arg-max token (lowest id among ties)."""
    return _lg(spark, sf).select("vec_id", sampling.greedy("logits").alias("token_id"))


@register("top_k_set")
def q_top_k_set(spark, sf):
    """The 10 best tokens per row with renormalised probabilities."""
    lg = _lg(spark, sf).withColumn("z", sampling.scale("logits", TEMPERATURE))
    c = sampling.with_top_k(lg, "z", 10, "cand")
    return sampling.explode_candidates(c, ["vec_id"], "cand").withColumn("prob", _r6("prob"))


@register("top_k_draw")
def q_top_k_draw(spark, sf):
    """Top-10 draw with a reproducible uniform from md5(vec_id:seed)."""
    s = sampling.sample(_lg(spark, sf), ["vec_id"], "logits", "top_k", 10, 0.9, TEMPERATURE, D.SEED)
    return s.select("vec_id", F.col("next_token").alias("token_id"))


@register("nucleus")
def q_nucleus(spark, sf):
    """The nucleus (p = 0.9) per row with renormalised probabilities."""
    lg = _lg(spark, sf).withColumn("z", sampling.scale("logits", TEMPERATURE))
    c = sampling.with_nucleus(lg, "z", 0.9, "cand")
    return sampling.explode_candidates(c, ["vec_id"], "cand").withColumn("prob", _r6("prob"))


@register("top_p_draw")
def q_top_p_draw(spark, sf):
    """Nucleus draw with a reproducible uniform."""
    s = sampling.sample(_lg(spark, sf), ["vec_id"], "logits", "top_p", 10, 0.9, TEMPERATURE, D.SEED)
    return s.select("vec_id", F.col("next_token").alias("token_id"))


# --------------------------------------------------------------------------- streaming

@register("stream_page_chunks")
def q_stream_page_chunks(spark, sf):
    """Page files as a stream, one micro-batch per file, read back; equals page_chunks."""
    from quire.streaming.jobs import CHUNK_SCHEMA, read_sink, run_page_chunks
    vocab = tokenize.fit_vocab(D.kept_pages(spark, sf), "text")
    paths = run_page_chunks(spark, sf, vocab, D.L_PAGE, files="pages.parquet",
                            max_files_per_trigger=1)
    ch = read_sink(spark, paths["chunks"], CHUNK_SCHEMA)
    return ch.select("page_id", "url", F.col("chunk_idx").cast("int").alias("chunk_idx"),
                     F.col("start").cast("int").alias("start"),
                     A.ids_text("input_ids").alias("input_ids"),
                     F.size("attention_mask").cast("int").alias("mask_len"))


@register("stream_rejects")
def q_stream_rejects(spark, sf):
    """The failed-URL table the page stream leaves behind (URL list = the pages)."""
    from quire.streaming.jobs import REJECT_SCHEMA, read_sink, run_page_chunks
    vocab = tokenize.fit_vocab(D.kept_pages(spark, sf), "text")
    paths = run_page_chunks(spark, sf, vocab, D.L_PAGE, files="pages.parquet",
                            max_files_per_trigger=1)
    return read_sink(spark, paths["rejects"], REJECT_SCHEMA).select(F.col("seq").alias("page_id"), "url", "reason")


@register("stream_recrawl")
def q_stream_recrawl(spark, sf):
    """The pages arrive, and again after a restart of the stream; failed URLs of the first time are blocklisted by keyed state."""
    from quire.session import scratch_path
    from quire.streaming.jobs import REJECT_SCHEMA, read_sink, run_page_chunks
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    src, out = scratch_path(spark, "page-files"), scratch_path(spark, "recrawl")
    vocab = tokenize.fit_vocab(D.kept_pages(spark, sf), "text")
    for part in (pages, pages.withColumn("page_id", -F.col("page_id") - 1)):
        part.write.mode("append").parquet(src)
        paths = run_page_chunks(spark, src, vocab, D.L_PAGE, out=out)
    return read_sink(spark, paths["rejects"], REJECT_SCHEMA).select(F.col("seq").alias("page_id"), "url", "reason")


@register("stream_metric_log")
def q_stream_metric_log(spark, sf):
    """Metrics observed while the batches of a page stream are written, as (tag, value) summed over the steps."""
    from quire.streaming.jobs import LOG_SCHEMA, read_sink, run_page_chunks
    vocab = tokenize.fit_vocab(D.kept_pages(spark, sf), "text")
    paths = run_page_chunks(spark, sf, vocab, D.L_PAGE, files="pages.parquet", max_files_per_trigger=1)
    return read_sink(spark, paths["log"], LOG_SCHEMA).groupBy("tag").agg(F.sum("value").cast("long").alias("value"))


@register("stream_padded_rows")
def q_stream_padded_rows(spark, sf):
    """Documents as a record stream -> padded rows; equals padded_rows."""
    from quire.streaming.jobs import ROW_SCHEMA, read_sink, run_padded_rows
    path = run_padded_rows(spark, sf, D.doc_vocab(spark, sf), 64, files="documents.parquet",
                           max_files_per_trigger=1)
    p = read_sink(spark, path, ROW_SCHEMA)
    return p.select("doc_id", A.ids_text("input_ids").alias("input_ids"),
                    A.ids_text("attention_mask").alias("attention_mask"))


# --------------------------------------------------------------------------- byte-level BPE

#: Merges of the query's vocabulary (a parameter of ``fit_bpe``, which has no bound of its own).
BPE_MERGES = 512


@register("bpe_encode")
def q_bpe_encode(spark, sf):
    """P6 mode b: byte-level BPE merges fitted on the documents, then every document encoded."""
    from quire.operators import bpe
    docs = D.documents(spark, sf)
    merges = bpe.fit_bpe(docs, "text", BPE_MERGES, tokenize.PRETOKEN_PATTERN)
    enc = bpe.bpe_encode(docs, merges, ["doc_id"], "text", "ids", tokenize.PRETOKEN_PATTERN)
    return enc.select("doc_id", F.size("ids").cast("long").alias("n_ids"), A.ids_text("ids").alias("ids"))
