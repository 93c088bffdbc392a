"""Token counts without token ids.

A text is cut into pre-tokens at places that no piece of the vocabulary can
span: before a line feed, which stands in no piece, and before the first blank of a run,
for no piece has a blank after another character.  Pieces are therefore counted once for
each distinct pre-token of the corpus.  The frequencies of a document's pre-tokens
meet these counts by a join: frequent pre-tokens (at most ``HOT_TYPES``
of at most ``HOT_BYTES`` bytes each, so a bounded broadcast) inside the task that reads the
text, all others in a shuffled join that holds no frequent key.  The products are summed per row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import binary_array, slices, text_buffer
from quire.operators.indexing import write_table

#: Pre-tokens looked up inside the reading task, and the bytes of the longest of them: 16 MB at most.
HOT_TYPES, HOT_BYTES = 1 << 18, 64
#: Text bytes cut at once.
CUT_BYTES = 1 << 20
#: Distinct pre-tokens given to the library at once.
COUNT_ROWS = 4096


def pretokens(col) -> tuple[pa.Array, np.ndarray]:
    """(pre-tokens of all texts, number of each text's).  A text that is not empty gets the blank
    in front that the library puts there."""
    data, off = text_buffer(col)
    full = off[1:] > off[:-1]
    data = np.insert(data, off[:-1][full], 32)
    off = off + np.append(0, np.cumsum(full))
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(len(full), np.int64)
    cut = data == 10
    before = np.append(np.uint8(10), data[:-1])
    # 0x81 may end U+2581, which the vocabulary takes for a blank
    cut |= (data == 32) & (before != 32) & (before != 0x81)
    cut[off[:-1][full]] = True
    at = np.flatnonzero(cut)
    bounds = np.append(at, len(data))
    return binary_array(data, bounds), np.diff(np.searchsorted(at, off, "left"))


def _types(docs: DataFrame) -> DataFrame:
    """t, n: distinct pre-tokens and their number in all texts; equal ones of a slice are added up first."""
    def run(batches):
        for b in slices(batches, "text", CUT_BYTES):
            tokens, _ = pretokens(b.column(0))
            if len(tokens):
                counts = tokens.value_counts()
                yield pa.RecordBatch.from_arrays([counts.field(0).cast(pa.binary()), counts.field(1)], names=["t", "n"])

    return docs.select("text").mapInArrow(run, "t binary, n bigint").groupBy("t").agg(F.sum("n").alias("n"))


_MODELS: dict = {}


def _model(proto: bytes):
    import sentencepiece

    key = hash(proto)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = sentencepiece.SentencePieceProcessor(model_proto=proto)
    return _MODELS[key]


def check_boundaries(proto: bytes) -> None:
    """Fails for a vocabulary whose pieces could span a cut, or that changes texts before it encodes them."""
    model = _model(proto)
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).lstrip("▁")
        if "▁" in piece or "\n" in piece:
            raise ValueError(f"piece {i} holds a blank or line feed inside: its pre-tokens cannot be counted alone")
    if model.encode("  ﬁ\t", out_type=str)[0] != "▁" * 3 or model.decode(model.encode("ﬁ\t ")) != "ﬁ\t ":
        raise ValueError("the vocabulary normalises texts: its pre-tokens cannot be counted alone")


def _counted(types: DataFrame, proto) -> DataFrame:
    """``types`` with ``pieces``, from the library, once for each.  A line feed put in front keeps the library's
    own blank away from the pre-token: both make one piece each."""
    def run(batches):
        model = _model(proto.value)
        for b in batches:
            for i in range(0, b.num_rows, COUNT_ROWS):
                part = b.slice(i, COUNT_ROWS)
                texts = ["\n" + t.decode("utf-8", "replace") for t in part.column(0).to_pylist()]
                counts = [len(x) - 2 for x in model.encode(texts, num_threads=1)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(counts, pa.int64())], names=["t", "n", "pieces"])

    return types.select("t", "n").mapInArrow(run, "t binary, n bigint, pieces bigint")


def _hot(types: DataFrame) -> DataFrame:
    """The most frequent short types: whole frequency steps of an eighth of a power of two, ``HOT_TYPES`` rows at most."""
    step = F.floor(F.log2("n") * 8)
    short = types.filter(F.length("t") <= HOT_BYTES).withColumn("step", step)
    total, least = 0, math.inf
    for s, k in sorted(((r["step"], r["count"]) for r in short.groupBy("step").count().collect()), reverse=True):
        total += k
        if total > HOT_TYPES:
            break
        least = s
    return short.filter(F.col("step") >= F.lit(float(least))).select("t", "pieces")


def count_tokens(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_bytes`` (UTF-8) and ``n_tokens``, row for row.

    Null and empty texts have 0 of both.  Repeated rows, null ids and any other columns stay as they are; columns
    that already have the names of the new ones are replaced.  An empty table gives none.  A text of any length
    is cut whole; a single pre-token of any length goes through the library alone.
    The vocabulary file is read on the driver and broadcast (a fixed size)."""
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        raw = f.read()
    check_boundaries(raw)
    proto = spark.sparkContext.broadcast(raw)
    keep = [c for c in docs.columns if c not in (text_col, "n_bytes", "n_tokens")]
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    types = write_table(_counted(_types(texts), proto), "pretoken-types")
    rows = _hot(types).collect()  # HOT_TYPES at most
    hot = spark.sparkContext.broadcast((pa.array([bytes(r["t"]) for r in rows], pa.binary()).cast(pa.large_binary()),
                                        np.array([r["pieces"] for r in rows], np.int64)))
    given = docs.select(F.struct(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), F.lit(0).alias("_")).alias("row"),
                        F.col(text_col).cast("string").alias("text")).withColumn("key", F.monotonically_increasing_id())

    def run(batches):
        known, pieces = hot.value
        for b in slices(batches, "text", CUT_BYTES):
            tokens, counts = pretokens(b.column("text"))
            coded = tokens.dictionary_encode()
            words = coded.dictionary
            where = pc.index_in(words, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            value = np.append(pieces, 0)[where]  # -1: not frequent
            # frequency of each pre-token of each row
            owner = np.repeat(np.arange(b.num_rows), counts)
            pairs, freq = np.unique(owner * max(len(words), 1) + coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
                                    return_counts=True)
            own, word = np.divmod(pairs, max(len(words), 1))
            hits = np.zeros(b.num_rows, np.int64)
            np.add.at(hits, own, freq * value[word])
            miss = where[word] < 0
            bounds = np.append(0, np.cumsum(np.bincount(own[miss], minlength=b.num_rows)))
            rest = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(
                [words.take(pa.array(word[miss])).cast(pa.binary()), pa.array(freq[miss], pa.int64())], names=["t", "f"]))
            size = np.diff(text_buffer(b.column("text"))[1])
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("row"), pa.array(size), pa.array(hits), rest],
                                             names=["key", "row", "n_bytes", "hits", "rest"])

    schema = given.select("key", "row").schema.add("n_bytes", "long").add("hits", "long").add(
        "rest", T.ArrayType(T.StructType().add("t", "binary").add("f", "long")))
    # written, so that the rows have the same keys in both uses
    rows = write_table(given.select("key", "row", "text").mapInArrow(run, schema), "pretoken-rows")
    rare = rows.select("key", F.inline("rest")).join(types.select("t", "pieces"), "t").groupBy("key").agg(
        F.sum(F.col("f") * F.col("pieces")).alias("rest"))
    out = rows.select("key", "row", "n_bytes", "hits").join(rare, "key", "left")
    return out.select(*(F.col("row")[f"_{i}"].alias(c) for i, c in enumerate(keep)), "n_bytes",
                      (F.col("hits") + F.coalesce("rest", F.lit(0))).alias("n_tokens"))
