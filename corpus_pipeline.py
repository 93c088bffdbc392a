"""Corpus pipeline: toxicity filter, n-gram Jaccard join (one document of each group stays), suffix-array
dedup, packing.  Every stage gets all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import stages
from quire.llm.common import prepare, table
from quire.operators.indexing import write_table

STAGES = [
    ("toxicity", stages.clean),
    ("ngram_join", stages.one_of_similar),
    ("suffix_dedup", stages.without_repeats),
    ("packing", stages.packed),
]

#: SQL cannot express the model, the components or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
