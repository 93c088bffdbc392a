"""Prefix trie of conversations with count-min screening.

Every prefix of a conversation gets a digest (sums of the turns' hashes, two lanes of 61 bits).  A count-min
sketch counts the digests; an estimate of one proves that no other conversation shares the prefix, so its
node is that conversation's alone and its row is made where the prefix is read.  Only the other prefixes, which
may be shared, are shuffled and grouped exactly.  A sketch has at most ``SKETCH_ROWS`` prefixes and a fixed size; more prefixes are dealt
to several sketches by their first turn, one after the other, so estimates stay as sharp and the broadcast as small on any table.

What a node sums over its subtree is carried by one conversation of each node: a leaf counts for, and
tokens are saved at, the smallest member of a node, whose own prefixes are all the node's ancestors.  So
subtree sums are running sums along conversations and one grouped sum, not a walk by depth.

Sorting, positions and sums of a conversation run over partitions (``running``): none is gathered, however long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.running import MASK, running
from quire.operators.indexing import write_table
from quire.session import scratch_path

#: Prefixes of one sketch, cells for each of them and rows: 8 MB broadcast and 64 MB in a counting task at most.
SKETCH_ROWS, CELLS_EACH, DEPTH = 1 << 23, 4, 2
#: Cells of one row of the sketch that are shuffled together.
BLOCK = 1 << 16
#: Turns of a conversation that meet its own row in one group.
LOT = 1 << 16
#: Nodes with more than 1 / ``BUSY`` of all children are broadcast (fewer than ``BUSY``), the others joined by shuffle.
BUSY = 10_000
#: Fixed values of the rebuilding rule.
HEADS, FAMILY = 9, 5


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations: conv_id, depth; their turns: conv_id, d from 1, digest, bytes, depth) after every conversation c takes the
    first h turns of conversation c - c % 5, or all if there are fewer, in place of its own first h; h = crc32(c) % 9."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    given = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.octet_length(text).cast("long").alias("bytes"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"))
    own = running(given.withColumn("i", F.lit(1)), "conv_id", ["turn", "digest"], ["i"], "turn-positions")
    h = F.crc32(F.col("conv_id").cast("string")) % HEADS
    sizes = write_table(own.groupBy("conv_id").agg(F.max("i").alias("n")), "conversation-sizes")
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    k = F.least(F.col("h"), F.coalesce("nb", F.lit(0)))
    convs = sizes.select("conv_id", "n", h.alias("h"), base.alias("base")).join(
        sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("nb")), "base", "left").withColumn("k", k)
    convs = write_table(convs.select("conv_id", "n", "base", "h", "k", (
        F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("depth")), "conversations")
    # a long conversation meets its row lot by lot
    lots = convs.filter("n > h").select("conv_id", "h", "k", "depth", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor(F.col("n") / LOT))).alias("lot"))
    tail = own.withColumn("lot", F.floor(F.col("i") / LOT)).join(lots, ["conv_id", "lot"]).filter("i > h").select(
        "conv_id", (F.col("k") + F.col("i") - F.col("h")).alias("d"), "digest", "bytes", "depth")
    first = own.filter((F.col("i") < HEADS) & (F.col("conv_id") % FAMILY == 0)).select(
        F.col("conv_id").alias("base"), "i", "digest", "bytes")
    head = first.join(convs.filter("k > 0"), "base").filter("i <= k").select(
        "conv_id", F.col("i").alias("d"), "digest", "bytes", "depth")
    return convs.select("conv_id", "depth"), head.unionByName(tail)


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, d, depth, bytes (of the last text), a, b (digest), pa, pb (the digest one turn before), top (of the first turn)."""
    lane = lambda i: F.xxhash64(F.lit(i), "digest", "d").bitwiseAND(F.lit(MASK))
    rows = turns.select("conv_id", "d", "depth", "bytes", lane(1).alias("ta"), lane(2).alias("tb")).select(
        "*", F.col("ta").alias("a"), F.col("tb").alias("b"), F.when(F.col("d") == 1, F.col("ta")).otherwise(0).alias("top"))
    before = lambda x: (F.col(x) - F.col("t" + x)).bitwiseAND(F.lit(MASK)).alias("p" + x)
    return running(rows, "conv_id", ["d"], ["a", "b", "top"], "prefix-sums").select(
        "conv_id", "d", "depth", "bytes", "a", "b", before("a"), before("b"), "top")


def _cells(a: np.ndarray, b: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cell of a digest in each row of the sketch."""
    return [((a + np.uint64(i) * b) >> np.uint64(7)).astype(np.int64) & (cells - 1) for i in range(DEPTH)]


def _long(batch, name) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.uint64)


def sketch(rows: DataFrame, cells: int) -> np.ndarray:
    """Bits (row, cell) that are set where the count-min sketch of the digests has counted two or more.

    Counts stop at two.  Tasks count alone; blocks of their counts are shuffled (2 bits a cell) and added in a stream."""
    def count(batches):
        at = np.zeros((DEPTH, cells), np.uint8)
        for batch in batches:
            for row, cell in zip(at, _cells(_long(batch, "a"), _long(batch, "b"), cells), strict=True):
                which, n = np.unique(cell, return_counts=True)
                row[which] = np.minimum(row[which] + np.minimum(n, 2).astype(np.uint8), 2)
        blocks = at.reshape(-1, min(BLOCK, cells))
        for i in np.flatnonzero(blocks.any(axis=1)):
            bits = [np.packbits(blocks[i] == v).tobytes() for v in (1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([bits[0]], pa.binary()), pa.array([bits[1]], pa.binary())],
                                             names=["block", "one", "two"])

    def add(batches):
        at, one, two = None, None, None
        for batch in batches:
            for block, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                if block != at:
                    if at is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([two.tobytes()], pa.binary())], names=["block", "two"])
                    at, one, two = block, x | y, y
                else:
                    two = two | y | (one & x)
                    one = one | x | y
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([two.tobytes()], pa.binary())], names=["block", "two"])

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = rows.select("a", "b").mapInArrow(count, "block bigint, one binary, two binary").repartition(n, "block")
    out = np.zeros((DEPTH * cells // min(BLOCK, cells), min(BLOCK, cells) // 8), np.uint8)
    for r in counted.sortWithinPartitions("block").mapInArrow(add, "block bigint, two binary").collect():  # the sketch's fixed size
        out[r["block"]] = np.frombuffer(r["two"], np.uint8)
    return out.reshape(DEPTH, -1)


def screen(rows: DataFrame, bits) -> DataFrame:
    """``rows`` with ``own`` and ``over``: whether the prefix, and the one a turn shorter, are proven to be of one conversation."""
    cells = bits.value.shape[1] * 8

    def alone(a, b):
        many = np.ones(len(a), bool)
        for row, cell in zip(bits.value, _cells(a, b, cells), strict=True):
            many &= (row[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)
        return ~many

    def run(batches):
        for b in batches:
            own = alone(_long(b, "a"), _long(b, "b"))
            over = alone(_long(b, "pa"), _long(b, "pb")) & (_long(b, "d") > 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own | over), pa.array(over)], names=[*b.schema.names, "own", "over"])

    return rows.mapInArrow(run, rows.select("*").schema.add("own", "boolean").add("over", "boolean"))


def screened(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` prefixes, screened by as many sketches as they need (written)."""
    spark = rows.sparkSession
    shards = max(1, -(-n // SKETCH_ROWS))
    cells = 1 << max(6, (CELLS_EACH * min(n, SKETCH_ROWS) - 1).bit_length())
    dealt, path = scratch_path(spark, "prefixes"), scratch_path(spark, "screened")
    rows = rows.withColumn("shard", (F.col("top") % shards).cast("int")).drop("top")
    rows.write.partitionBy("shard").parquet(dealt)
    given = spark.read.schema(rows.schema).parquet(dealt)
    for s in range(shards):  # one sketch at a time: all prefixes of a node are in the same
        part = given.filter(F.col("shard") == s).drop("shard")
        bits = spark.sparkContext.broadcast(sketch(part, cells))
        screen(part, bits).write.mode("append").parquet(path)
        bits.unpersist()
    return spark.read.schema(given.drop("shard").schema.add("own", "boolean").add("over", "boolean")).parquet(path)


def end_digests(ends: DataFrame) -> DataFrame:
    """d, a, b, ends: SHA-256 of the comma-joined conv_ids, ascending, of each node.

    Ids are sorted over all partitions and joined to pieces there; the hash of a node reads its pieces in a stream."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    node = ["d", "a", "b"]

    def join(batches):
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in node])
            ids = b.column("conv_id").to_pylist()
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), len(ids)]
            heads = pa.array(cuts[:-1])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(heads) for c in [*node, "conv_id"]),
                 pa.array([",".join(map(str, ids[i:j])) for i, j in zip(cuts, cuts[1:], strict=False)], pa.string())],
                names=[*node, "conv_id", "piece"])

    def digest(batches):
        at, sha = None, None
        done = lambda: pa.RecordBatch.from_arrays(
            [*(pa.array([x], pa.int64()) for x in at), pa.array([sha.hexdigest()])], names=[*node, "ends"])
        for batch in batches:
            for *key, piece in zip(*(batch.column(c).to_pylist() for c in [*node, "piece"]), strict=True):
                if key != at:
                    if at is not None:
                        yield done()
                    at, sha = key, hashlib.sha256(piece.encode())
                else:
                    sha.update(b"," + piece.encode())
        if at is not None:
            yield done()

    order = [*node, "conv_id"]
    pieces = ends.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(
        join, "d bigint, a bigint, b bigint, conv_id bigint, piece string")
    return pieces.repartition(n, *node).sortWithinPartitions(*order).select(*node, "piece").mapInArrow(
        digest, "d bigint, a bigint, b bigint, ends string")


def build(turns: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node of the trie of the rebuilt
    conversations of ``turns`` (conv_id, turn, role, text; other columns play no part).

    Null roles and texts are empty, a null turn comes first, turns of equal number are in the order of their md5 digests (so
    repeated rows are repeated turns), rows without a conv_id belong to no conversation.  A table without rows has no node."""
    node = ["d", "a", "b"]
    convs, rebuilt = rebuild(turns)
    total, n, least, turnless = convs.agg(F.coalesce(F.sum("depth"), F.lit(0)), F.count(F.lit(1)), F.min("conv_id"),
                                          F.count_if(F.col("depth") == 0)).first()
    rows = screened(prefixes(rebuilt), total)
    shared, single = rows.filter(~F.col("own")), rows.filter("own")

    zero = F.lit(0).cast("long")
    root = turns.sparkSession.createDataFrame([(0, 0, 0, n, least, 0, 0, 0)] if n else [],
                                              "d long, a long, b long, n long, conv_id long, pa long, pb long, bytes long")
    nodes = write_table(shared.groupBy(*node).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.max("pa").alias("pa"), F.max("pb").alias("pb"),
        F.max("bytes").alias("bytes")).unionByName(root), "shared-nodes")
    up = [(F.col("d") - 1).alias("d"), F.col("pa").alias("a"), F.col("pb").alias("b")]
    fresh = single.filter(~F.col("over"))  # the first prefix of a conversation that is its own
    children = nodes.filter("d > 0").select(*up).unionByName(fresh.select(*up)).groupBy(*node).agg(F.count(F.lit(1)).alias("children"))
    nodes = write_table(nodes.join(children, node, "left").fillna(0, ["children"]), "nodes-children")

    # leaves and saved tokens stand at one conversation's prefix; sums over the longer prefixes of the same conversation
    leaf = (F.col("children") == 0).cast("long")
    weights = single.filter("d = depth").select("conv_id", "d", F.lit(1).cast("long").alias("leaves"), zero.alias("saved")).unionByName(
        nodes.filter("d > 0").select("conv_id", "d", leaf.alias("leaves"), ((F.col("n") - 1) * F.col("bytes")).alias("saved")).filter(
            "leaves > 0 or saved > 0"))
    weights = write_table(weights, "node-weights")
    lines = weights.select("conv_id", (-F.col("d")).alias("back"), F.lit(0).alias("kind"), zero.alias("a"), zero.alias("b"), "leaves", "saved")
    lines = lines.unionByName(shared.select("conv_id", (-F.col("d")).alias("back"), F.lit(1).alias("kind"), "a", "b",
                                            zero.alias("leaves"), zero.alias("saved")))
    sums = running(lines, "conv_id", ["back", "kind"], ["leaves", "saved"], "subtree-sums").filter("kind = 1").groupBy(
        (-F.col("back")).alias("d"), "a", "b").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    whole = weights.agg(F.coalesce(F.sum("leaves"), zero).alias("leaves"), F.coalesce(F.sum("saved"), zero).alias("saved")).select(
        zero.alias("d"), zero.alias("a"), zero.alias("b"), F.greatest("leaves", F.lit(1)).alias("leaves"), "saved")
    ends = end_digests(shared.filter("d = depth").select(*node, "conv_id").unionByName(
        convs.filter("depth = 0").select(zero.alias("d"), zero.alias("a"), zero.alias("b"), "conv_id")))
    kids = nodes.join(sums.unionByName(whole), node).join(ends, node, "left").select(
        "conv_id", "d", "pa", "pb", "n", "children", "leaves", "saved", F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends"))

    one, last = F.lit(1).cast("long"), F.col("d") == F.col("depth")
    own = lambda df: df.select(
        "conv_id", "d", "pa", "pb", one.alias("n"), (~last).cast("long").alias("children"), one.alias("leaves"), zero.alias("saved"),
        F.sha2(F.when(last, F.col("conv_id").cast("string")).otherwise(""), 256).alias("ends"))
    kids = write_table(kids.unionByName(own(fresh)), "nodes-parents")
    above = nodes.select((F.col("d") + 1).alias("d"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("up"), "children")
    busy = F.col("children") * BUSY > F.lit(nodes.agg(F.sum("children")).first()[0] or 0)
    key = ["d", "pa", "pb"]
    found = kids.join(F.broadcast(above.filter(busy).drop("children")), key, "left")  # fewer than BUSY nodes have so many children
    rare = kids.join(above.filter(busy).select(*key), key, "left_anti").join(above.filter(~busy).drop("children"), key, "left")
    # a prefix that only seemed to be shared below one that is proven not to be has that one as parent
    seemed = rare.withColumn("up", F.when(F.col("d") > 0, F.coalesce("up", "conv_id")))
    out = found.filter("up is not null").unionByName(seemed).unionByName(
        own(single.filter("over")).withColumn("up", F.col("conv_id")))
    return out.select("conv_id", F.col("d").alias("depth"), F.col("up").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                      F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.col("ends").alias("ends_sha256"))
