"""Line files: read (strip, drop blanks), row ids, synthetic repetition, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import single_line, split_lines, ustrip

#: Text bytes of a part of repeated lines: beyond 1 MB Parquet's writer gives up a column's dictionary and writes every copy whole.
#: More parts than ``MOST_PARTS`` are not made (a job of that many tasks); parts are larger then, and so is what is written.
PART_BYTES, MOST_PARTS = 640 << 10, 1 << 16


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A text file as ``(value)`` rows: both ends stripped (Unicode), blank lines dropped."""
    df = spark.read.text(path, wholetext=False)
    return df.select(ustrip("value").alias("value")).where(F.col("value") != "")


def lines_of(df: DataFrame, key_cols: list, text_col: str = "text") -> DataFrame:
    """Texts held in a table, split into stripped non-blank lines with their position."""
    from quire.sources.corpus import spread
    ex = spread(df.select(*key_cols, text_col)).select(
        *key_cols, F.posexplode(split_lines(text_col)).alias("pos", "line"))
    return (ex.select(*key_cols, F.col("pos").cast("long").alias("pos"), ustrip("line").alias("text"))
              .where(F.col("text") != ""))


def with_row_id(df: DataFrame, order_cols: list, id_col: str = "line_id") -> DataFrame:
    """Stable dense 0-based index in ``order_cols`` order (random access by ``filter``)."""
    from quire.operators.indexing import with_global_index
    return with_global_index(df, order_cols, id_col)


def repeat_lines(lines: DataFrame, repeat: int = 100, order_col: str = "pos",
                 text_col: str = "text") -> DataFrame:
    """Every line ``repeat`` times, order kept: ``line_id = rep * n + pos``.

    ``lines`` carries a dense 0-based ``order_col``.  The repetition is a
    generator (``explode(sequence)``) inside each row: no join.  Before it the
    lines, still once each, are dealt by range into parts of at most about
    ``PART_BYTES`` of text, so that a columnar writer keeps a part's texts in its
    dictionary and each copy is a few bits.
    """
    n, size = lines.agg(F.max(order_col), F.sum(F.octet_length(text_col) + 4)).first()
    n = 0 if n is None else int(n) + 1
    if repeat <= 0:
        return lines.sparkSession.createDataFrame([], "line_id long, text string")
    lines = lines.repartitionByRange(min(1 + int(size or 0) // PART_BYTES, MOST_PARTS), order_col)
    out = lines.select(F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))).alias("rep"), order_col, text_col)
    return out.select((F.col("rep").cast("long") * n + F.col(order_col)).alias("line_id"),
                      F.col(text_col).alias("text"))


def write_lines(df: DataFrame, path: str, text_col: str = "text", mode: str = "overwrite") -> None:
    """One text per line; empty texts skipped, inner line breaks become one space."""
    (df.where(F.col(text_col).isNotNull() & (F.col(text_col) != ""))
       .select(single_line(text_col).alias("value"))
       .write.mode(mode).text(path))
