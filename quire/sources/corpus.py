"""Record and article sources over Parquet tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import is_nonempty


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition when ``df`` has fewer partitions than the cluster's
    parallelism (e.g. one large row group), so expensive per-row work (HTML
    parsing, pre-token regex) does not run in a single task.  Inputs that
    already have enough splits (the large-data case) are left as they are.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One Parquet table of a data folder (``base/name.parquet``)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


PARTS = ("name", "config", "split")


def write_corpus(df: DataFrame, root: str) -> None:
    """Store records below ``root`` as folders ``name=/config=/split=`` (columns of ``df``)."""
    df.write.mode("append").partitionBy(*PARTS).parquet(root)


def _layout(spark: SparkSession, root: str, name: str, config: str, split: str) -> tuple[str, bool]:
    """(what to read, whether it is a folder of partitions): partition columns, or one literal folder ``root/name/config/split``."""
    base = root.rstrip("/")
    try:
        return base, set(PARTS) <= set(spark.read.parquet(base).columns)
    except AnalysisException:  # no Parquet files or partitions at the top: a literal path
        return base, False


def read_corpus(spark: SparkSession, root: str, name: str, config: str | None,
                split: str = "train", text_col: str = "text", stream: bool = False) -> DataFrame:
    """A named / configured / split record collection, as a table or (``stream``) as a stream of its files.

    ``root`` has partition columns name, config and split, of which only the wanted folders are listed and read, or plain folders
    ``root/name/config/split``.  A missing ``config`` is refused, as the streaming reader refuses it.  Null and empty texts are left out.
    """
    if config is None:
        raise ValueError("a dataset config is required for a named record collection")
    base, parts = _layout(spark, root, name, config, split)
    path = base if parts else f"{base}/{name}/{config}/{split}"
    if stream:
        df = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    else:
        df = spark.read.parquet(path)
    if parts:
        df = df.where((F.col("name") == name) & (F.col("config") == config) & (F.col("split") == split))
    return df.where(is_nonempty(text_col))


def nonempty_records(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Record-stream rule: drop null and '' texts, keep white-space-only ones."""
    return df.where(is_nonempty(text_col))


#: Steps of a key's range that are counted at once.
STEPS = 1024


def kth_key(df: DataFrame, key: str, k: int) -> int | None:
    """The ``k``-th smallest value of an integer column (repeats count), None if there are fewer.

    Its range is counted in ``STEPS`` equal steps, then the step that holds the k-th value, and so on: at most seven scans of
    this one column with a pushed range, and ``STEPS`` counts to the driver each time, however large ``k`` is."""
    lo, hi, n = df.agg(F.min(key), F.max(key), F.count(key)).first()
    if n < k:
        return None
    before = 0
    while lo < hi:
        width = -(-(hi - lo + 1) // STEPS)
        inside = df.where(F.col(key).between(lo, hi)).select(F.col(key).cast("decimal(20,0)").alias("v"))
        # whole decimals: the range of a long is wider than a long
        steps = inside.groupBy(F.expr(f"cast((v - ({lo}BD)) div {width}BD as int)").alias("s")).count().collect()
        for r in sorted(steps, key=lambda r: r["s"]):
            if before + r["count"] >= k:
                lo, hi = lo + r["s"] * width, min(hi, lo + (r["s"] + 1) * width - 1)
                break
            before += r["count"]
    return lo


def read_articles(df: DataFrame, order_col: str = "doc_id", max_articles: int | float | None = None) -> DataFrame:
    """Article stream with a cap on articles read (None or 0 = all).

    The cap counts articles, including those that later give no chunk; the
    first ``max_articles`` in ``order_col`` order (an integer column) are kept, with all rows that share the last key; rows without a key
    have no place in the order.  The last key is found by counting (``kth_key``), so the rest is a range filter that reaches the scan:
    no sort, and nothing that grows with the cap is broadcast.
    """
    if not max_articles:
        return df
    last = kth_key(df, order_col, int(max_articles))
    return df.where(F.col(order_col).isNotNull() if last is None else F.col(order_col) <= last)
