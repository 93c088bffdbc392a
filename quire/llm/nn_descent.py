"""Approximate nearest neighbours (operator 7): an NN-descent graph, searched greedily.

The graph starts from neighbours inside blocks of vectors that lie on the same sides of
random directions' medians (several times; a block that is too large is cut again at its own
medians until none is), then every node's neighbours and
reverse neighbours are compared with each other, round by round, by joins of the edge table
with itself through the node; what comes out better is kept, until hardly an edge changes.  Graph and search measure
the vectors as they are, in double precision (results are the exact distances).  A query starts at the
neighbours of its own node and keeps its ``beam`` nearest nodes; the neighbours of those not yet
expanded are measured until none of them comes in.

Defined results: a row with a null id, or with a null, empty, zero or not wholly finite vector,
takes no part; equal vectors are one node with their smallest ids (as many as an answer can
hold); a row is no candidate of its own id; vectors of several lengths form graphs of their own;
ties go to the smaller id; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import sorted_groups
from quire.llm.vectors import distinct_vectors, matrix, packed
from quire.operators.indexing import write_table

#: Neighbours of a node, reverse neighbours compared in a round, ways to cut blocks at the start and their size,
#: share of edges that change in the last round, beam.
NEIGHBOURS, REVERSE, DIRECTIONS, BLOCK, DELTA, BEAM = 24, 20, 6, 4096, 0.001, 128
#: Axes that cut a block again at once, and cuts after which blocks are dealt by a hash (vectors that no axis tells apart).
AXES, DEEP = 4, 16
_FLUSH, _ROWS = 400_000, 1024
_EDGES = "node long, near long, dist double"


def _best(node: np.ndarray, near: np.ndarray, dist: np.ndarray, k: int):
    """The ``k`` nearest of each node, each pair once."""
    order = np.lexsort((near, dist, node))
    node, near, dist = node[order], near[order], dist[order]
    pair = np.lexsort((near, node))  # equal pairs have equal distances, so one of them goes
    again = np.zeros(len(node), bool)
    if len(node):
        again[pair[1:]] = (node[pair][1:] == node[pair][:-1]) & (near[pair][1:] == near[pair][:-1])
    node, near, dist = node[~again], near[~again], dist[~again]
    first = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else np.zeros(0, int)
    rank = np.arange(len(node)) - np.repeat(first, np.diff(np.append(first, len(node))))
    keep = rank < k
    return node[keep], near[keep], dist[keep]


def _batch(node, near, dist) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(near, pa.int64()), pa.array(dist, pa.float64())],
                                      names=["node", "near", "dist"])


def _compare(groups, k: int):
    """Each group's ids, vectors and worst neighbours: the ``k`` nearest of each member among
    the group's others that beat its worst; results are merged inside the task before they leave."""
    held, size = [], 0
    for ids, v, worst in groups:
        sq = (v * v).sum(axis=1)
        m = min(k, len(ids) - 1)
        for x in range(0, len(ids) if m > 0 else 0, _ROWS):
            d = sq[x:x + _ROWS, None] + sq[None, :] - 2 * (v[x:x + _ROWS] @ v.T)
            own = np.arange(len(d))
            d[own, own + x] = np.inf
            near = np.argpartition(d, m - 1, axis=1)[:, :m]
            d = np.maximum(np.take_along_axis(d, near, 1), 0)
            i, j = np.nonzero(d < worst[x:x + _ROWS, None])
            held.append((ids[x + i], ids[near[i, j]], d[i, j]))
            size += len(i)
            if size > _FLUSH:
                yield _batch(*_best(*(np.concatenate(c) for c in zip(*held, strict=True)), k))
                held, size = [], 0
    if held:
        yield _batch(*_best(*(np.concatenate(c) for c in zip(*held, strict=True)), k))


def _members(batches, keys, kind: str):
    for g in sorted_groups(batches, keys):
        ids, first = np.unique(g.column("id").to_numpy(), return_index=True)
        yield ids, matrix(g.column("v").to_pylist(), kind)[first].astype(np.float64), g.column("worst").to_numpy()[first]


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` best edges of each node: merged per task, then per node."""

    def merge(batches):
        for g in _by_size(batches):
            yield _batch(*_best(g.column("node").to_numpy(), g.column("near").to_numpy(), g.column("dist").to_numpy(), k))

    def _by_size(batches):
        held = []
        for g in sorted_groups(batches, ["node"]):
            held.append(g)
            if len(held) >= 2000:
                yield pa.concat_tables(held)
                held = []
        if held:
            yield pa.concat_tables(held)

    return edges.repartition("node").sortWithinPartitions("node").mapInArrow(merge, _EDGES)


def _blocks(nodes: DataFrame, kind: str, total: int, directions: int, block: int) -> DataFrame:
    """way, size, slot, id, v: ``directions`` times every node (once if all fit), in cells of ``block`` nodes at most."""
    cell = ["way", "size", "slot"]
    ways = F.explode(F.array(*map(F.lit, range(directions if total > block else 1))))
    left = nodes.select("id", "v", ways.alias("way"), F.length("v").alias("size"), F.lit("").alias("slot"))
    done, depth, most = None, 0, total
    while most > block:
        axes = int(np.ceil(np.log2(most / block)))
        if depth < DEEP:
            cells = _cut(left, kind, min(axes, AXES) if depth else axes, depth, cell)
        else:
            salt = F.pmod(F.xxhash64("id", "way", F.lit(depth)), F.lit(2 << axes))
            cells = left.select("way", "size", F.concat_ws("/", "slot", salt).alias("slot"), "id")
        cells = write_table(cells, "cells")
        counts = write_table(cells.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")), "cell-sizes")
        most = counts.agg(F.max("n")).first()[0]
        # a row for each cell that is too large, ``directions / block`` of the nodes at most: a bounded broadcast
        big = F.broadcast(counts.filter(F.col("n") > block).select(*cell))
        small = cells.join(big, cell, "left_anti")
        done = small if done is None else done.unionByName(small)
        left, depth = cells.join(big, cell, "left_semi").join(nodes, "id"), depth + 1
    return left if done is None else done.join(nodes, "id")


def _cut(rows: DataFrame, kind: str, axes: int, depth: int, cell: list[str]) -> DataFrame:
    """way, size, slot, id of ``rows`` with longer slots: the sides of so many new directions' medians, those of the
    row's own cell."""

    def project(batches):
        for b in batches:
            ways, v = b.column("way").to_pylist(), [np.frombuffer(x, kind).astype(np.float64) for x in b.column("v").to_pylist()]
            to = {(w, n): np.random.default_rng((depth, w, n)).standard_normal((axes, n))
                  for w, n in {(w, len(x)) for w, x in zip(ways, v, strict=True)}}
            p = [(to[w, len(x)] @ x).tolist() for w, x in zip(ways, v, strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in (*cell, "id")), pa.array(p, pa.list_(pa.float64()))],
                                             names=[*cell, "id", "places"])

    placed = write_table(rows.mapInArrow(project, "way int, size int, slot string, id long, places array<double>"), "directions")
    cuts = placed.groupBy(*cell).agg(F.array(F.lit(0.0), *[
        F.percentile_approx(F.col("places")[x], 0.5) for x in range(axes)]).alias("cuts"))
    sides = F.concat_ws("", F.transform("places", lambda p, x: (p > F.get("cuts", x + 1)).cast("int").cast("string")))
    return placed.join(F.broadcast(cuts), cell).select("way", "size", F.concat_ws("/", "slot", sides).alias("slot"), "id")


def build_graph(nodes: DataFrame, kind: str, neighbours: int = NEIGHBOURS, reverse: int = REVERSE, directions: int = DIRECTIONS,
                block: int = BLOCK, delta: float = DELTA) -> DataFrame:
    """node, near, dist (squared) from ``nodes``: id, v (packed as ``kind``)."""
    keys, total = ["way", "size", "slot"], nodes.count()
    dealt = _blocks(nodes, kind, total, directions, block).withColumn("worst", F.lit(float("inf")))

    def start(batches):
        yield from _compare(_members(batches, keys, kind), neighbours)

    def meet(batches):
        yield from _compare(_members(batches, ["via"], kind), neighbours)

    graph = write_table(_nearest(dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(start, _EDGES), neighbours), "graph")
    before = None
    while total > block:  # else all pairs have met
        back = Window.partitionBy("near").orderBy("dist", "node")
        reversed_ = graph.withColumn("r", F.row_number().over(back)).filter(F.col("r") <= reverse).select(
            F.col("near").alias("via"), F.col("node").alias("id"))
        around = write_table(graph.select(F.col("node").alias("via"), F.col("near").alias("id")).unionByName(reversed_).unionByName(
            nodes.select(F.col("id").alias("via"), "id")).distinct(), "around")
        # where nobody is new, all have met
        fresh = around if before is None else around.join(before, ["via", "id"], "left_anti")
        open_ = around.join(fresh.select("via").distinct(), "via", "left_semi")
        before = around

        known = graph.groupBy(F.col("node").alias("id")).agg(
            F.when(F.count(F.lit(1)) >= neighbours, F.max("dist")).alias("worst"))
        ready = nodes.join(known, "id", "left").withColumn("worst", F.coalesce("worst", F.lit(float("inf"))))
        met = open_.join(ready, "id").select("via", "id", "v", "worst").repartition("via").sortWithinPartitions("via").mapInArrow(meet, _EDGES)
        better = write_table(_nearest(graph.unionByName(met), neighbours), "graph")
        changed = better.join(graph.select("node", "near"), ["node", "near"], "left_anti").count()
        graph = better
        if changed <= delta * graph.count():
            break
    return graph


def _measure(pairs: DataFrame, kind: str) -> DataFrame:
    """query, node, dist (in double precision) from the packed vectors ``qv`` and ``v``."""

    def run(batches):
        for b in batches:
            qv, v = b.column("qv").to_pylist(), b.column("v").to_pylist()
            if len({*map(len, qv), *map(len, v)}) == 1:
                x, y = (matrix(c, kind).astype(np.float64) for c in (qv, v))
                d = np.sqrt(((x - y) ** 2).sum(axis=1))
            else:  # vectors of several lengths
                d = [float(np.sqrt(((np.frombuffer(x, kind).astype(np.float64) - np.frombuffer(y, kind).astype(np.float64)) ** 2).sum()))
                     for x, y in zip(qv, v, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("query"), b.column("node"), pa.array(d, pa.float64())],
                                             names=["query", "node", "dist"])

    return pairs.select("query", "node", "qv", "v").mapInArrow(run, "query long, node long, dist double")


def search(queries: DataFrame, vectors: DataFrame, k: int, beam: int = BEAM, id_col: str = "vec_id",
           vector_col: str = "embedding", **graph) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for each query row (a row of ``vectors``, too)."""
    kind = "<f4" if dict(vectors.dtypes)[vector_col] == "array<float>" else "<f8"
    pack = lambda v: v.astype(kind).tobytes() if v.any() else None
    nodes = distinct_vectors(packed(vectors.unionByName(queries), pack, id_col, vector_col), k + 1)
    nodes = write_table(nodes.select(F.element_at("ids", 1).alias("id"), "ids", "v"), "nodes")
    edges = build_graph(nodes.select("id", "v"), kind, **graph)
    links = write_table(edges.groupBy("node").agg(F.collect_list("near").alias("nears")), "links")

    # a query starts at its own node, which is the node of its vector
    asked = write_table(packed(queries, pack, id_col, vector_col).distinct().join(
        nodes.select(F.col("id").alias("node"), "v"), "v").select(F.col("id").alias("query"), "node", F.col("v").alias("qv")), "queries")
    vectors_ = nodes.select(F.col("id").alias("node"), "v")
    asks = asked.select("query", "qv")
    known = write_table(asked.select("query", "node", F.lit(0.0).alias("dist"), F.lit(False).alias("opened")), "beam")
    while True:
        fresh = known.filter("not opened").join(links, "node").select("query", F.explode("nears").alias("node")).distinct()
        fresh = fresh.join(known.select("query", "node"), ["query", "node"], "left_anti")
        pairs = fresh.join(vectors_, "node").join(asks, "query")
        both = known.withColumn("opened", F.lit(True)).unionByName(_measure(pairs, kind).withColumn("opened", F.lit(False)))
        order = Window.partitionBy("query").orderBy("dist", "node")
        known = write_table(both.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= beam).drop("r"), "beam")
        if known.filter("not opened").isEmpty():
            break
    rows = known.select("query", "node", "dist").join(nodes.select(F.col("id").alias("node"), "ids"), "node").select(
        "query", "dist", F.explode("ids").alias("vec_id")).filter("vec_id <> query")
    order = Window.partitionBy("query").orderBy("dist", "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        F.col("query").alias("query_id"), "rank", "vec_id", F.col("dist").alias("score"))
