"""Vector tables: valid vectors as packed bytes, equal vectors once with their smallest ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _valid(col, ids) -> list[tuple[int, np.ndarray]]:
    """(id, vector in double precision) of the rows that have an id and only finite components."""
    out = []
    values = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
    ends = np.cumsum(col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    for i, end in zip(ids.to_pylist(), ends.tolist(), strict=True):
        if i is not None and end > at and np.isfinite(values[at:end]).all():
            out.append((i, values[at:end]))
        at = end
    return out


def packed(rows: DataFrame, pack, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, v (binary) of every valid row; ``pack(vector) -> bytes or None`` (None: takes no part)."""

    def run(batches):
        for b in batches:
            own = [(i, p) for i, v in _valid(b.column("vector"), b.column("id")) if (p := pack(v)) is not None]
            ids, vs = zip(*own, strict=True) if own else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vs, pa.binary())], names=["id", "v"])

    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).mapInArrow(
        run, "id long, v binary")


def distinct_vectors(vectors: DataFrame, keep: int) -> DataFrame:
    """v, ids (its ``keep`` smallest ids, ascending): a vector that many rows share is merged in each
    task and in lots before it meets in one place."""

    def combine(batches):
        for b in batches:
            by: dict[bytes, list] = {}
            for i, v in zip(b.column("id").to_pylist(), b.column("v").to_pylist(), strict=True):
                by.setdefault(v, []).append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(by), pa.binary()), pa.array([sorted(set(x))[:keep] for x in by.values()], pa.list_(pa.int64()))],
                names=["v", "ids"])

    merged = F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids")
    parts = vectors.mapInArrow(combine, "v binary, ids array<long>").withColumn("lot", F.spark_partition_id() % 64)
    return parts.groupBy("v", "lot").agg(merged).groupBy("v").agg(merged)


def matrix(values: list, kind: str) -> np.ndarray:
    """Rows of packed vectors of one length."""
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)
