"""Exact top-k search (operator 4): Fagin's threshold algorithm.

Distinct vectors lie in blocks of bounded size; a block keeps, for each
dimension, its vectors sorted by that component.  A query walks down the lists of its non-zero
components together (from the other end where its component is negative), scores
every vector when it is first seen, and stops when no unseen vector can reach the
worst of the best: the components at the current depth bound every unseen score.
Walks that would see most of a block before they stop score the whole block together.
Each block is exact for itself, and the blocks' results are merged.

Defined results: a row with a null id, or with a null, empty or not wholly finite vector,
takes no part; repeated rows count once; a row is no candidate of its own id; vectors of
another length than the query's are not compared; ties go to the smaller id; empty
tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.vectors import distinct_vectors, matrix, packed
from quire.operators.indexing import write_table

SCALE, BLOCK_ROWS, LOT = 256, 65_536, 1_024
_FIRST_DEPTH, _TOGETHER = 16, 64


def _floors(scale: int):
    """Integer components, as bytes; a component beyond 63 bits takes its vector out."""
    def pack(v: np.ndarray) -> bytes | None:
        x = np.floor(scale * v)
        return x.astype("<i8").tobytes() if np.abs(x).max() < 2.0 ** 62 else None

    return pack


class SortedLists:
    """A block of integer vectors with its sorted lists, one for each dimension."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.order = np.argsort(rows, axis=0, kind="stable")
        top = float(np.abs(rows).max()) if rows.size else 0.0
        self.limit = top * rows.shape[1]
        self._as: dict = {}
        # depths at which a walk looks at its bound, with the components that stand there from either end
        n, d = len(rows), _FIRST_DEPTH
        self.depths = []
        while n and (not self.depths or self.depths[-1] < n):
            self.depths.append(min(d, n))
            d = 2 * d + _FIRST_DEPTH
        at = np.array(self.depths, np.int64)
        self.ends = [np.take_along_axis(rows, self.order[i], axis=0) for i in (at - 1, n - at)]

    def _like(self, kind) -> np.ndarray:
        """The rows as ``kind``, made once."""
        if kind not in self._as:
            self._as[kind] = self.rows.astype(kind)
        return self._as[kind]

    def best(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row numbers, scores) that hold the ``k`` highest scores, ties with the k-th included."""
        return self.best_of([query], k)[0]

    def best_of(self, queries: list[np.ndarray], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """``best`` of each query.  Walks whose bound lies so deep that the lists down to it name most of the block
        go to the end together: their scores with the rows are one matrix product."""
        found, deep = {}, {}
        for i, query in enumerate(queries):
            exact = self.limit * float(np.abs(query).max(initial=0)) < 2 ** 53
            kind = np.float64 if exact else object
            out = self._walk(query.astype(kind), kind, k)
            if out is None:
                deep.setdefault(kind, []).append(i)
            else:
                found[i] = out
        for kind, which in deep.items():
            rows, step = self._like(kind), _TOGETHER if kind is np.float64 else 1
            for x in range(0, len(which), step):
                part = which[x:x + step]
                for i, known in zip(part, np.stack([queries[i] for i in part]).astype(kind) @ rows.T, strict=True):
                    found[i] = _highest(np.arange(len(rows)), known, k)
        return [found[i] for i in range(len(queries))]

    def _walk(self, q: np.ndarray, kind, k: int) -> tuple[np.ndarray, np.ndarray] | None:
        """``best`` by a walk down the lists; None if it would see most of the block."""
        n, rows = len(self.rows), self._like(kind)
        up, down = np.flatnonzero(q < 0), np.flatnonzero(q > 0)
        if not n or not len(up) + len(down):  # a query of zeros scores 0 with all
            return np.arange(n), np.zeros(n, np.int64)
        low, high = (e.astype(kind) for e in self.ends)
        edges = (low[:, up] * q[up]).sum(axis=1) + (high[:, down] * q[down]).sum(axis=1)  # what an unseen vector can reach at most, by depth
        seen = np.zeros(n, bool)
        who, scores, depth = [], [], 0
        for j, end in enumerate(self.depths):
            ids = np.unique(np.concatenate([self.order[depth:end, up].ravel(), self.order[n - end:n - depth, down].ravel()]))
            ids = ids[~seen[ids]]
            seen[ids] = True
            who.append(ids)
            scores.append(rows[ids] @ q)
            depth = end
            known = np.concatenate(scores)
            if len(known) == n:
                break
            below = np.zeros(0, np.int64)
            if len(known) >= k:
                below = np.flatnonzero(edges[j:] < np.sort(known)[-k])
                if len(below) and not below[0]:
                    break
            stop = self.depths[j + below[0]] if len(below) else n if len(known) >= k else self.depths[j + 1]
            if stop * (len(up) + len(down)) > n:
                return None
        return _highest(np.concatenate(who), np.concatenate(scores), k)


def _highest(who: np.ndarray, known: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores and the ties of the last."""
    if len(known) > k:
        kth = np.sort(known)[-k] if known.dtype == object else np.partition(known, len(known) - k)[-k]
        keep = known >= kth
        who, known = who[keep], known[keep]
    return who, known


def search(queries: DataFrame, vectors: DataFrame, k: int, scale: int = SCALE, block_rows: int = BLOCK_ROWS,
           lot: int = LOT, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` highest integer inner products of each query row."""
    pack = _floors(scale)
    asked = write_table(packed(queries, pack, id_col, vector_col).distinct(), "queries")
    given = write_table(distinct_vectors(packed(vectors, pack, id_col, vector_col), k + 1), "distinct-vectors")
    blocks, lots = max(1, -(-given.count() // block_rows)), max(1, -(-asked.count() // lot))

    def spread(df, side, own, others):
        at = F.pmod(F.xxhash64("v"), F.lit(own)).cast("int").alias(side)
        other = "lot" if side == "block" else "block"
        return df.select("*", at, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other),
                         F.length("v").alias("size"))

    def run(block: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(block) and len(ask):
            lists = SortedLists(matrix(list(block["v"]), "<i8"))
            ids = list(block["ids"])
            best = lists.best_of([np.frombuffer(v, "<i8") for v in ask["v"]], k + 1)
            for qid, (who, scores) in zip(ask["id"], best, strict=True):
                found = sorted((-int(s), int(i)) for w, s in zip(who, scores, strict=True) for i in ids[w] if i != qid)
                out.extend((qid, i, -s) for s, i in found[:k])
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    keys = ["block", "lot", "size"]
    found = spread(given, "block", blocks, lots).groupBy(*keys).cogroup(
        spread(asked, "lot", lots, blocks).groupBy(*keys)).applyInPandas(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
