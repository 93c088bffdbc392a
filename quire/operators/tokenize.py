"""Pre-tokenization, vocabulary fit, encode and decode as Spark jobs.

Mode (a), the default: a corpus vocabulary over regex pre-tokens.  Ids are
ranked by (count desc, token asc); id 0 is the end-of-text token, which also
serves as padding, id 1 the unknown token, corpus tokens start at 2.

Physical shape (see README, "scale notes"):

* the vocabulary count is a hash aggregate with map-side partial counts, so a
  hot token costs one row per map task, not one row per occurrence;
* ranking uses the distributed dense index (no single-task window);
* encode and decode look items up where the row is (``operators.lookup``): a broadcast dictionary
  bounded in bytes, and a join of the distinct misses only.  No text is shuffled, and the plan is
  the same for a vocabulary of any size.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.indexing import with_global_index, write_table
from quire.operators.lookup import Dictionary, dictionary_end, lookup
from quire.operators.lookup import dictionary as lookup_dictionary

# Pre-token patterns.  PRETOKEN_PATTERN is the form accepted by
# both Java regex and RE2; GPT2_PATTERN is the published byte-level GPT-2 rule
# (needs look-ahead, Java only).
PRETOKEN_PATTERN = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
GPT2_PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Special ids.  Padding reuses end-of-text.
EOS_ID = 0
PAD_ID = EOS_ID
UNK_ID = 1
FIRST_ID = 2
EOS_TOKEN = "<|endoftext|>"
UNK_TOKEN = "<|unk|>"

#: Entries of the broadcast part of a vocabulary (its bytes are bounded by ``lookup.DICT_BYTES``).
HOT_VOCAB = 500_000
#: Tokens that a worker has in memory when it splits unknown pre-tokens, and the bits of its filter of the others.
PIECES = 50_000
PIECE_BITS = 1 << 27


def pretoken_array(col: Column | str, pattern: str = PRETOKEN_PATTERN) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(c, F.lit(pattern), 0)


def pretokens(df: DataFrame, key_cols: list, text_col: str = "text",
              pattern: str = PRETOKEN_PATTERN) -> DataFrame:
    """One row per pre-token: ``key_cols, pos (0-based), token``."""
    from quire.sources.corpus import spread
    return spread(df.select(*key_cols, text_col)).select(
        *key_cols, F.posexplode(pretoken_array(text_col, pattern)).alias("pos", "token"))


def fit_vocab(df: DataFrame, text_col: str = "text", max_size: int | None = None,
              pattern: str = PRETOKEN_PATTERN) -> DataFrame:
    """Vocabulary ``(token, id, count)`` fitted on ``text_col``; top ``max_size`` if given."""
    from quire.sources.corpus import spread
    toks = spread(df.select(text_col)).select(F.explode(pretoken_array(text_col, pattern)).alias("token"))
    counts = toks.groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    if max_size:
        counts = counts.orderBy(F.desc("count"), F.asc("token")).limit(int(max_size))
    # one pass over the corpus: the counts are written once, ranking and the
    # range partitioner's sample read the (vocabulary-sized) table
    counts = write_table(counts, "vocab-counts")
    ranked = with_global_index(counts, [F.desc("count"), F.asc("token")], "rank")
    return write_table(ranked.select("token", (F.col("rank") + FIRST_ID).cast("int").alias("id"),
                                     F.col("count").cast("long").alias("count")), "vocab")


def vocab_size(vocab: DataFrame) -> int:
    """Number of ids including the two special ones (max id + 1)."""
    m = vocab.agg(F.max("id")).first()[0]
    return FIRST_ID if m is None else int(m) + 1


def vocab_size_column(config_size: Column, tokenizer_size: Column) -> Column:
    """max(config vocab size, tokenizer size), a missing config value counting as 0."""
    return F.greatest(F.coalesce(config_size, F.lit(0)), tokenizer_size)


def encode(df: DataFrame, vocab: DataFrame, key_cols: list | None = None, text_col: str = "text",
           out_col: str = "ids", pattern: str = PRETOKEN_PATTERN, hot_size: int = HOT_VOCAB,
           fallback=None, max_tokens: int | None = None, made: Dictionary | None = None,
           dealt: bool = False) -> DataFrame:
    """Replace ``text_col`` by ``out_col`` = token ids in text order (unknown -> ``UNK_ID``); null and empty texts give no ids.

    ``max_tokens`` cuts the pre-tokens before any lookup.  ``fallback`` (see ``prefix_pieces``) splits unknown pre-tokens into
    known ones.  ``made``: the ``dictionary`` of ``vocab``, for many calls without a fallback.  ``dealt``: ``df`` is the result of a
    shuffle, whose partitions could only be counted by running it.  ``key_cols`` is not needed any more: rows keep their own identity."""
    from quire.sources.corpus import spread
    toks = pretoken_array(text_col, pattern)
    if max_tokens:
        toks = F.slice(toks, 1, int(max_tokens))
    base = (df if dealt else spread(df)).withColumn("_toks", toks).drop(text_col)
    rank, ids = (F.col("id") - FIRST_ID).alias("rank"), "id"
    if fallback is None:
        return lookup(base, "_toks", vocab.select("token", "id", rank), "token", ids, "rank", out_col, UNK_ID, most=hot_size, made=made)
    # an unknown pre-token becomes several ids, so every value is a list
    table = vocab.select("token", F.array("id").alias("ids"), rank)
    out = lookup(base, "_toks", table, "token", "ids", "rank", out_col, [UNK_ID], most=hot_size, fallback=fallback)
    flat = F.flatten(out_col)
    return out.withColumn(out_col, F.slice(flat, 1, int(max_tokens)) if max_tokens else flat)


def dictionary(vocab: DataFrame, hot_size: int = HOT_VOCAB) -> Dictionary:
    """The broadcast part of ``vocab``, made once for many calls of ``encode``."""
    return lookup_dictionary(vocab.select("token", "id", (F.col("id") - FIRST_ID).alias("rank")), "token", "id", "rank", hot_size)


def prefix_pieces(vocab: DataFrame, size: int = PIECES):
    """Fallback for unknown pre-tokens: greedy longest prefixes among the tokens of ``vocab``, all of them.

    From the left, the longest token that the rest begins with is taken; a character that none begins with is ``UNK_ID``.
    The most frequent tokens (``size`` at most, and ``lookup.DICT_BYTES``) are in a worker's memory; of the others it has a filter of
    ``PIECE_BITS`` at most, and what passes that is looked up in the table.  The result does not depend on either
    bound; each distinct unknown pre-token is split once."""
    table = vocab.where("token <> ''").select("token", "id", (F.col("id") - FIRST_ID).alias("rank"))
    end = dictionary_end(table, "token", "id", "rank", size)
    rest = table.where(F.col("rank") >= end)
    rows = table.where(F.col("rank") < end).collect()  # ``size`` at most
    # the lengths of the tokens by their first character, longest first
    heads = table.groupBy(F.substring("token", 1, 1).alias("head")).agg(F.collect_set(F.length("token")).alias("lengths")).collect()
    bits = _filter(rest)
    pieces = vocab.sparkSession.sparkContext.broadcast(
        ({r["token"]: r["id"] for r in rows}, {r["head"]: sorted(r["lengths"], reverse=True) for r in heads}, bits))

    def split(items: DataFrame) -> DataFrame:
        def cut(batches):
            for b in batches:
                found = [_choices(*pieces.value, t) for t in b.column(0).to_pylist()]
                at, stop, ids, ask = zip(*found) if found else ((), (), (), ())
                ints, texts = pa.list_(pa.int32()), pa.list_(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(at, ints), pa.array(stop, ints), pa.array(ids, ints), pa.array(ask, texts)],
                    names=["item", "at", "stop", "id", "ask"])

        def walk(batches):
            for b in batches:
                lists = (b.column(c).to_pylist() for c in ("at", "stop", "id", "got"))
                yield pa.RecordBatch.from_arrays(
                    [b.column("item"), pa.array([_greedy(*x) for x in zip(*lists, strict=True)], pa.list_(pa.int32()))],
                    names=["item", "value"])

        places = items.mapInArrow(cut, "item string, at array<int>, stop array<int>, id array<int>, ask array<string>")
        if bits:
            places = lookup(places, "ask", rest, "token", "id", "rank", "got", most=0)
        else:
            places = places.withColumn("got", F.array().cast("array<int>")).drop("ask")
        return places.mapInArrow(walk, "item string, value array<int>")

    return split


def _filter(rest: DataFrame) -> bytes:
    """One bit by the checksum of each token of ``rest``: 32 bits a token and ``PIECE_BITS`` at most; nothing for no tokens."""
    n = rest.count()
    if not n:
        return b""
    size = min(PIECE_BITS, 1 << (32 * n - 1).bit_length())
    at = F.crc32(F.col("token").cast("binary")) % size
    words = rest.groupBy(F.shiftright(at, 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(crc32(cast(token as binary)) % 64 as int))")).alias("b")).toArrow()  # size / 64 rows
    out = np.zeros(size >> 6, "<i8")
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out.tobytes()


def _choices(known: dict, heads: dict, bits: bytes, text: str) -> tuple[list, list, list, list]:
    """What may be taken at each place that the walk may come to, longest first: (places, ends, ids, strings to look up).

    An id of -k is that of the k-th string, if it is a token; the last choice of a place is certain."""
    at, stop, ids, ask = [], [], [], {}
    size, come = 8 * len(bits), {0}
    for i in range(len(text)):
        if i not in come:
            continue
        come.discard(i)
        best, end = UNK_ID, i + 1
        for n in heads.get(text[i], ()):
            if i + n > len(text):
                continue
            part = text[i:i + n]
            if part in known:
                best, end = known[part], i + n
                break
            if size:
                h = zlib.crc32(part.encode()) % size
                if bits[h >> 3] >> (h & 7) & 1:
                    at.append(i)
                    stop.append(i + n)
                    ids.append(-ask.setdefault(part, len(ask) + 1))
                    come.add(i + n)
        at.append(i)
        stop.append(end)
        ids.append(best)
        come.add(end)
    return at, stop, ids, list(ask)


def _greedy(at: list, stop: list, ids: list, got: list) -> list[int]:
    """The ids along the walk from the left; ``got`` has those of the strings looked up, None for no token."""
    out, here = [], 0
    for i, end, x in zip(at, stop, ids, strict=True):
        if i == here:
            x = got[-x - 1] if x < 0 else x
            if x is not None:
                out.append(x)
                here = end
    return out


def decode(df: DataFrame, vocab: DataFrame, key_cols: list | None = None, ids_col: str = "ids",
           out_col: str = "text", hot_size: int = HOT_VOCAB) -> DataFrame:
    """Ids back to text; special ids (end-of-text, unknown) and ids outside the vocabulary are skipped."""
    base = df.withColumn("_own", F.filter(ids_col, lambda x: x >= FIRST_ID)).drop(ids_col)
    table = vocab.select("token", "id", (F.col("id") - FIRST_ID).alias("rank"))
    out = lookup(base, "_own", table, "id", "token", "rank", "_toks", None, most=hot_size)
    return out.withColumn(out_col, F.array_join("_toks", "")).drop("_toks")


def lookup_ids(df: DataFrame, table: DataFrame, id_col: str, hot_size: int = HOT_VOCAB) -> DataFrame:
    """Left join ``table`` (keyed by ``id``) on ``df[id_col]``.

    Ids below ``hot_size + FIRST_ID`` come from a broadcast of at most that many
    rows; when the table is larger the remaining ids are shuffle-joined (rare
    ids by construction, so no hot key on that side).
    """
    n_ids = vocab_size(table)
    t = table.withColumnRenamed("id", id_col) if id_col != "id" else table
    bound = hot_size + FIRST_ID
    small = t.where(F.col(id_col) < bound)
    if n_ids <= bound:
        return df.join(F.broadcast(small), id_col, "left")
    hot = F.coalesce(F.col(id_col), F.lit(0)) < bound
    return (df.where(hot).join(F.broadcast(small), id_col, "left")
            .unionByName(df.where(~hot).join(t.where(F.col(id_col) >= bound), id_col, "left")))



def encode_with(df: DataFrame, tokenizer, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """Encode with a user tokenizer: ``tokenizer(pandas.Series[str]) -> Series[list[int]]``,
    run as an Arrow ``pandas_udf`` per batch (the callable form of the tokenizer argument)."""

    @F.pandas_udf("array<int>")
    def _enc(s: pd.Series) -> pd.Series:
        return tokenizer(s)

    return df.withColumn(out_col, _enc(F.col(text_col))).drop(text_col)


def save_vocab(vocab: DataFrame, path: str) -> None:
    """Store a fitted vocabulary ``(token, id, count)`` as Parquet."""
    vocab.select("token", "id", "count").write.mode("overwrite").parquet(path)


def load_vocab(spark, path: str) -> DataFrame:
    """A stored vocabulary; padding reuses the end-of-text id (PAD_ID == EOS_ID)."""
    return spark.read.parquet(path).select("token", F.col("id").cast("int"), F.col("count").cast("long"))
