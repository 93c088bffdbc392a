"""Dense global row index without a single-partition window.

``row_number() over (order by k)`` with no partition pulls every row into one
task.  Here the rows are range-partitioned on the order key, sorted inside each
partition, and numbered locally with ``monotonically_increasing_id`` (partition
index in the high bits, local position in the low 33 bits).  Per-partition
counts (one row per partition: a proven size bound) are summed into offsets
on the driver and broadcast back.  The numbered rows are first written as a table in the
session's shared checkpoint folder, so a lost executor cannot renumber them
(a recomputed range shuffle could move rows between partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import scratch_path

_LOW_BITS = (1 << 33) - 1


def with_global_index(df: DataFrame, order_cols: list, index_col: str = "idx",
                      num_partitions: int | None = None) -> DataFrame:
    """Append ``index_col`` = 0-based position of each row in ``order_cols`` order.

    ``order_cols`` must make the order total (add a unique tiebreaker).  The
    range partitioner samples its input in a separate job, so an expensive
    ``df`` should be a written table (see ``write_table``) to avoid computing
    it twice.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "dense-index")
    (df.repartitionByRange(n, *order_cols)
       .sortWithinPartitions(*order_cols)
       .withColumn("_mid", F.monotonically_increasing_id())
       .write.parquet(path))
    numbered = spark.read.parquet(path)
    pid = F.shiftright(F.col("_mid"), 33)
    # one row per partition: bounded by the partition count, so the prefix sums
    # are taken on the driver and the offsets broadcast back
    counts = sorted((r["_pid"], r["_n"]) for r in
                    numbered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n")).collect())
    offsets, run = [], 0
    for p, c in counts:
        offsets.append((p, run))
        run += c
    off = spark.createDataFrame(offsets, "_pid long, _off long")
    return (numbered.join(F.broadcast(off), pid == off["_pid"])
            .withColumn(index_col, F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))
            .drop("_mid", "_pid", "_off"))


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Materialise ``df`` as Parquet in the session's shared checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads the table instead of recomputing
    the plan) and makes a later scan cheap.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # known: no job to find it
