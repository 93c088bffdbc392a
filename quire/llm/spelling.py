"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Two words are near when one inserted, deleted or replaced code point makes them equal.  The
shorter one (or either, at equal lengths) contributes two disjoint chunks, its halves; the edit leaves one
of them whole, and it stands in the other word no more than one place further on.  The other word contributes
the grams that can meet such a chunk: of all its positional grams those of a chunk's length at
a chunk's place, unmoved or moved by the difference in length.  Chunk and gram meet by an equi-join on one key.

A chunk that many words share (``SPLIT``) is not joined: there the method is applied again to the half that
may differ, so the words of the group meet by three quarters, seven eighths and so on, until no group is
large or a single place is left, where the alphabet bounds it.  ``level`` counts these steps, ``part`` is the segment of
``2 ** level`` that may differ.  The part that holds the first difference is the one that a pair is taken from, so no
pair comes twice, and an exact distance check ends the search.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.indexing import write_table
from quire.sources.corpus import spread

#: Fixed values of the word rule: letters, shortest word, fewest occurrences, share of runs that lose a code point.
LETTERS, SHORTEST, FEWEST, TYPO = "A-Za-zÀ-ÿ", 7, 2, 31
#: A form occurs at least this many times as often as its word.
FORM_RATIO = 10
#: Words that may share a chunk before the rest of them is cut further.
SPLIT = 48
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: distinct lower-cased words and their occurrences.

    Of the runs whose crc32 (with the id, '' for a null one) 31 divides, one code point is deleted."""
    runs = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"[{LETTERS}]{{{SHORTEST},}}"), F.lit(0))
    ids = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    lower = spread(docs.select(ids.alias("id"), F.col(text_col))).select("id", F.explode(runs).alias("run")).select(
        "id", F.translate("run", _UPPER, _LOWER).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = lower.withColumn("h", h).select(F.when(F.col("h") % TYPO == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= SHORTEST).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") >= FEWEST)


def _border(part: Column) -> Column:
    """Start of segment ``part`` of a word of length ``size`` in ``2 ** level`` segments."""
    return F.floor(part * F.col("size") / F.pow(F.lit(2), F.col("level"))).cast("int")


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, size, level, part) with their key: all but the part that may differ, which lies
    ``length(word) - size`` places longer in a word that is the longer one.  Empty parts go."""
    rows = rows.withColumn("a", _border(F.col("part"))).withColumn("b", _border(F.col("part") + 1)).filter("a < b")
    moved = F.col("b") + F.length("word") - F.col("size")
    return rows.withColumn("key", F.xxhash64("size", "level", "part", F.substring("word", F.lit(1), F.col("a")),
                                             F.substring("word", moved + 1, F.length("word"))))


def near_pairs(words: DataFrame) -> DataFrame:
    """x, nx, y, ny: every two words of ``words`` (distinct; word, n) that are exactly one edit apart, once."""
    size = F.length("word")
    # the chunks of a word's own length, and the grams for a partner that is one code point shorter
    rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("size")).filter("size > 0").select(
        "*", F.lit(1).alias("level"), F.explode(F.array(F.lit(0), F.lit(1))).alias("part"))
    found = None
    while True:
        rows = write_table(_keyed(rows), "chunks")
        # partial sums: a chunk of a third of all words is counted, never gathered
        hot = rows.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.max(F.col("b") - F.col("a")).alias("wide")).filter(
            (F.col("k") > SPLIT) & (F.col("wide") > 1)).select("key")
        hot = write_table(hot, "hot-chunks")
        left = rows.join(hot, "key", "left_anti")
        x = left.filter(F.length("word") == F.col("size")).select(
            "key", "size", "b", F.col("word").alias("x"), F.col("n").alias("nx"))
        y = left.select("key", F.col("word").alias("y"), F.col("n").alias("ny"))
        one = (F.length("x") < F.length("y")) | (F.col("x") < F.col("y"))
        first = (F.col("b") == F.col("size")) | (F.substring("x", F.lit(1), F.col("b")) != F.substring("y", F.lit(1), F.col("b")))
        pairs = x.join(y, "key").filter(one & first & (F.levenshtein("x", "y", 1) == 1)).select("x", "nx", "y", "ny")
        found = pairs if found is None else found.unionByName(pairs)
        if hot.isEmpty():
            return found
        rows = rows.join(hot, "key", "left_semi").select(
            "word", "n", "size", (F.col("level") + 1).alias("level"),
            F.explode(F.array(F.col("part") * 2, F.col("part") * 2 + 1)).alias("part"))


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``docs``.

    Null and empty texts, and tables without rows, have no words.  Repeated rows count as often as they stand there; other
    columns play no part.  Of near words that occur equally often the smallest in code-point order is the form.  Runs of any
    length are words.  ``root`` is ``word`` where there is no form."""
    words = write_table(words_of(docs, id_col, text_col), "words")
    pairs = near_pairs(words)
    both = pairs.select(F.col("x").alias("word"), F.col("y").alias("o"), F.col("ny").alias("m")).unionByName(
        pairs.select(F.col("y").alias("word"), F.col("x").alias("o"), F.col("nx").alias("m")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "o")).alias("best"))
    # a word's own n rides along: the join below has one row of each word on both sides
    known = write_table(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.m") >= FORM_RATIO * F.col("n"), F.struct(F.col("best.o").alias("form"),
                                                                      (-F.col("best.m")).alias("form_n"))).alias("f")), "near-words")
    ups = write_table(known.filter("f is not null").select("word", F.col("f.form").alias("root")), "forms")
    # n grows tenfold with every step, so a chain has at most log10(n) of them; each round doubles the reach
    top = words.agg(F.max("n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(max(1.0, math.log10(top))))):
        above = ups.select(F.col("word").alias("root"), F.col("root").alias("above"))
        ups = write_table(ups.join(above, "root", "left").select("word", F.coalesce("above", "root").alias("root")), "roots")
    return known.join(ups, "word", "left").select(
        "word", F.col("f.form").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near",
        F.col("f.form_n").alias("form_n"))
