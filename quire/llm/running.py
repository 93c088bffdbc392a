"""Running sums inside groups of any size.

A window over a group runs in one task, however large the group.  Here rows are range-partitioned and
sorted by group and order, summed inside each partition in one pass, and written; the sums that a group brings
from earlier partitions (one row per partition) are added up on the driver and joined back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.indexing import write_table

#: Sums are taken modulo 2 ** 61, so that two of them add up without overflow.
MASK = (1 << 61) - 1


def running(df: DataFrame, key: str, order: list, sums: list[str], name: str) -> DataFrame:
    """``df`` with every column of ``sums`` (not negative) replaced by its sum over the rows of the same ``key`` (bigint, no nulls)
    up to this one in ``order``, modulo 2 ** 61."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in df.columns if c not in sums]
    rows = df.select(*rest, *(F.col(c).cast("long").alias(c) for c in sums)).repartitionByRange(n, key, *order).sortWithinPartitions(
        key, *order).select("*", F.spark_partition_id().cast("long").alias("_p"), F.lit(0).cast("long").alias("_i"))

    names, schema = rows.columns, rows.schema

    def run(batches):
        last, held, at = None, np.zeros(len(sums), np.uint64), 0
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(key).to_numpy(zero_copy_only=False)
            first = np.append(keys[0] != last, keys[1:] != keys[:-1])
            starts = np.append(0, np.flatnonzero(first[1:]) + 1)
            own = np.searchsorted(starts, np.arange(len(keys)), "right") - 1
            cols = []
            for j, c in enumerate(sums):
                total = np.append(np.uint64(0), np.cumsum(b.column(c).to_numpy(zero_copy_only=False).astype(np.uint64)))
                before = total[starts]
                if not first[0]:
                    before[0] -= held[j]
                cols.append((total[1:] - before[own]) & np.uint64(MASK))
                held[j] = cols[-1][-1]
            last = keys[-1]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in rest), *(pa.array(c.astype(np.int64)) for c in cols), b.column("_p"),
                 pa.array(np.arange(at, at + len(keys)))], names=names)
            at += len(keys)

    part = write_table(rows.mapInArrow(run, schema), name)
    ends = part.groupBy("_p").agg(F.min(key).alias("first"), F.max(key).alias("last"),
                                  F.max_by(F.struct(*sums), "_i").alias("end")).collect()  # one row per partition
    carry, before = [], None
    for r in sorted(ends, key=lambda r: r["_p"]):
        own = before[1] if before and before[0] == r["first"] else [0] * len(sums)
        if any(own):
            carry.append((r["_p"], r["first"], *own))
        alone = r["first"] == r["last"]
        before = (r["last"], [(x + (o if alone else 0)) & MASK for x, o in zip(r["end"], own, strict=True)])
    if not carry:
        return part.drop("_p", "_i")
    table = df.sparkSession.createDataFrame(carry, ", ".join(f"{c} long" for c in ("_p", key, *(f"_{i}" for i in range(len(sums))))))
    return part.join(F.broadcast(table), ["_p", key], "left").select(
        *rest, *((F.col(c) + F.coalesce(f"_{i}", F.lit(0))).bitwiseAND(F.lit(MASK)).alias(c) for i, c in enumerate(sums)))
