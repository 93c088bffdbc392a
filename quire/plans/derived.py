"""Tables the registered queries derive from the driver tables.

Each derivation has a twin CTE in ``quire.plans.oracle`` so the DuckDB check
computes the same input.  All of them grow with the data they read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.html import article_text, page_text
from quire.operators import runs, tokenize
from quire.sources.corpus import spread, table
from quire.sources.lines import lines_of

L_PAGE = 64          # window length of the crawl stream (dataset default)
L_ARTICLE = 256      # window length of the article stream (trainer default)
BATCH_SIZE = 32
SEED = 42


def kept_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages reduced to their article text, kept iff longer than 200 characters."""
    pages = spread(table(spark, sf, "pages"))
    txt = pages.select("page_id", "url", article_text("html").alias("text"))
    return txt.where(F.length("text") > 200)


def plain_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = spread(table(spark, sf, "pages"))
    return pages.select("page_id", "url", page_text("html").alias("text"))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


def doc_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return tokenize.fit_vocab(documents(spark, sf), "text")


def encoded_docs(spark: SparkSession, sf: str, vocab: DataFrame | None = None) -> DataFrame:
    v = vocab if vocab is not None else doc_vocab(spark, sf)
    return tokenize.encode(documents(spark, sf), v, ["doc_id"], "text", "ids")


def doc_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines_of(documents(spark, sf), ["doc_id"], "text")


def url_list(spark: SparkSession, sf: str) -> DataFrame:
    """The crawl list: every page URL (``seq = 2*page_id``) followed by its form
    without query and fragment (``seq = 2*page_id + 1``).  The second form is a
    repeat when the URL had neither, and a page that was never stored otherwise."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    a = pages.select((F.col("page_id") * 2).alias("seq"), "url")
    b = pages.select((F.col("page_id") * 2 + 1).alias("seq"),
                     F.regexp_replace("url", r"[?#].*$", "").alias("url"))
    return a.unionByName(b)


def history_from_events(events: DataFrame) -> DataFrame:
    """Derived loss histories: a run per user, an epoch per active day,
    ``eval_loss = round(avg(value), 6)``, ``train_loss = round(avg(ln(1 + value)), 6)``."""
    day = events.groupBy(F.col("user_id").alias("run"), F.to_date("ts").alias("day")).agg(
        F.round(F.avg("value"), 6).alias("eval_loss"),
        F.round(F.avg(F.log1p("value")), 6).alias("train_loss"),
        F.min("ts").alias("first_ts"))
    return runs.number_epochs(day, "run", "day")


#: Model name of the derived runs.
MODEL_NAME = "quire-model"


def history(spark: SparkSession, sf: str) -> DataFrame:
    """Loss histories (one row per run and day: far smaller than ``events``),
    written once because the run queries read them in several branches."""
    from quire.operators.indexing import write_table
    return write_table(history_from_events(table(spark, sf, "events")), "history")


def run_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names found in a runs folder: each run's start-time name plus names that
    must not match (date only, a suffixed copy)."""
    starts = history(spark, sf).groupBy("run").agg(F.min("first_ts").alias("ts"))
    full = runs.run_name(F.col("ts"))
    return (starts.select(full.alias("run_time"))
            .unionByName(starts.select(F.date_format("ts", "yyyy-MM-dd").alias("run_time")))
            .unionByName(starts.select(F.concat(full, F.lit("_old")).alias("run_time"))))


def logits(spark: SparkSession, sf: str) -> DataFrame:
    """One logits vector per row: the embedding vector, its label as the target id."""
    return table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("logits"), "label")


def given_vocab(spark: SparkSession, sf: str) -> DataFrame:
    """A vocabulary that was not fitted on the documents: that of the conversations' texts, stored and loaded again."""
    from quire.session import scratch_path
    path = scratch_path(spark, "given-vocab")
    tokenize.save_vocab(tokenize.fit_vocab(table(spark, sf, "conversations").select("text"), "text"), path)
    return tokenize.load_vocab(spark, path)


def unigram_nll(tokens: DataFrame, vocab: DataFrame, id_col: str = "label") -> DataFrame:
    """Derived per-token losses of ``tokens`` from corpus frequencies, ``-ln(count / total)``: the data holds no model's losses."""
    total = vocab.agg(F.sum("count")).first()[0] or 0
    per_id = vocab.select(F.col("id"), (-F.log(F.col("count") / F.lit(float(total)))).alias("nll"))
    return tokenize.lookup_ids(tokens, per_id, id_col)
