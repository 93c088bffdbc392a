"""What a Python worker is given at once is bounded in bytes, whatever the rows' number and size."""

from pyspark.sql import functions as F

from quire.plans import derived as D
from quire.plans.queries import QUERIES
from quire.session import ARROW_BYTES
from tests.conftest import SF_SMALL


def test_registered_queries_bound_the_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    QUERIES["page_text"](spark, SF_SMALL)

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]}, schema=pa.schema([("n", pa.int64())]))

    rows = spark.range(400, numPartitions=1).select(F.repeat(F.lit("word "), 20_000).alias("text"))  # 40 MB
    most = rows.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]
    assert most <= ARROW_BYTES + 200_000


def test_text_queries_are_equal_with_batches_of_one_row(spark):
    from quire.operators import bpe, tokenize
    docs = D.documents(spark, SF_SMALL).where("doc_id < 10")
    vocab = tokenize.fit_vocab(docs.where("doc_id < 5"), "text")

    def results():
        merges = bpe.fit_bpe(docs, "text", 4, tokenize.PRETOKEN_PATTERN)
        ids = bpe.bpe_encode(docs, merges, ["doc_id"], "text", "ids", tokenize.PRETOKEN_PATTERN)
        known = tokenize.encode(docs, vocab, text_col="text", out_col="ids", fallback=tokenize.prefix_pieces(vocab))
        return merges, *(sorted((r.doc_id, tuple(r.ids)) for r in x.collect()) for x in (ids, known))

    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    want = results()
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "2000")
        assert results() == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
