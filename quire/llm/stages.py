"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

Null texts and ids, repeated rows and empty tables are treated as the operators
say.  All columns of ``docs`` are kept as they are, whatever their names, but the text where a stage changes it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import ngram_join, packing, suffix_dedup, toxicity
from quire.llm.common import prepare, table
from quire.llm.queries import tokenizer_path
from quire.operators.indexing import write_table

#: Words of a shingle and percent of shared shingles from which two documents of the pipeline are similar (op3's own are 4 and 85).
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
#: Bytes from which a repeated string goes: some 50 words of four letters and a space (op2's own are 400, as its contract says, so
#: that a repeated passage of 50 words would stay).
PASSAGE_BYTES = 250


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labels of the data folder, does not reject."""
    prepare(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    names = {c: c if c == "text" else f"_{i}" for i, c in enumerate(docs.columns)}
    scored = model.score(docs.select(*(F.col(c).alias(n) for c, n in names.items())), list(names.values()))
    return scored.filter(F.col("score") < 0.5).select(*(F.col(n).alias(c) for c, n in names.items()))


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of linked documents, that of smallest id (a null id comes last).

    Rows are joined by a key of their own, so rows of one id with different texts are different documents, rows
    with a null id take part, and of equal rows one stays; blank texts are alike only where their ids are equal, too."""
    prepare(spark)
    names = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    # written, so that a row has the same key wherever it is read
    rows = write_table(docs.select(*(F.col(c).alias(n) for c, n in names.items())).withColumn(
        "key", F.monotonically_increasing_id()), "keyed-documents")
    doc_id, text = F.col(names["doc_id"]), F.col(names["text"]).cast("string")
    groups = ngram_join.join_similar(rows.select(F.col("key").alias("doc_id"), text.alias("text")),
                                     words=SHINGLE_WORDS, percent=SIMILAR_PERCENT).withColumnRenamed("doc_id", "key")
    blank = F.when(text.rlike(r"\A[\x20\x09-\x0D]*\z"), text)
    empty = F.col("n_shingles") == 0
    # the first row of each group, by partial sums: no group meets in one task
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key"))["key"]
    kept = rows.select("key", doc_id.alias("id"), blank.alias("blank")).join(groups, "key").groupBy(
        F.when(~empty, F.col("component_id")).alias("a"), F.when(empty, F.col("id")).alias("b"),
        F.when(empty, F.col("blank")).alias("c")).agg(first.alias("key"))
    return rows.join(kept.select("key"), "key", "left_semi").select(*(F.col(n).alias(c) for c, n in names.items()))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of repeated ``PASSAGE_BYTES``-byte strings; what is left of a cut character goes, too.
    ``n_chars`` is counted again where the table has it."""
    prepare(spark)
    columns = docs.columns
    cut = suffix_dedup.remove_repeats(docs, keep=[c for c in columns if c != "text"], length=PASSAGE_BYTES)

    def decode(batches):
        for b in batches:
            kept = [v.decode("utf-8", "ignore") for v in b.column("kept").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(kept, pa.string())], names=["row", "text"])

    out = cut.select("row", "kept").mapInArrow(decode, cut.select("row").schema.add("text", "string"))
    count = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in columns else None
    return out.select(*(F.col("text") if c == "text" else count.alias(c) if c == "n_chars" else F.col("row")[c].alias(c)
                        for c in columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2048 ids."""
    prepare(spark)
    return packing.pack(docs.select("doc_id", "text"), tokenizer_path("word_bpe_49k.json"))
