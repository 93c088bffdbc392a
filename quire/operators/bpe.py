"""Byte-level BPE (tokenizer mode b) as Spark jobs.

fit:    pre-tokens -> word-type histogram (an aggregate; vocabulary-sized, not corpus-sized).  The
        types lie in blocks of flat id arrays; the occurrences of every adjacent pair, block by block, are a table that is both
        the pair counts and the index from pair to blocks.  A round takes the next merges in order (most frequent pair,
        ties: the smaller pair) as far as none can change another's place (``next_merges``), reads the blocks that the index names
        and appends the differences of the counts.  So one Spark round makes many merges and reads what their pairs touch; every
        ``cut_every`` rounds blocks and counts are written anew.
encode: distinct word types of the input get their ids once (merges applied lowest first, many types at a
        time); texts meet them where they are read (``operators.lookup``).

Ids: 0 is end-of-text / padding, byte b is ``b + 1``, merge number r is ``257 + r``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.indexing import with_global_index, write_table
from quire.operators.lookup import lookup
from quire.operators.tokenize import GPT2_PATTERN, HOT_VOCAB, pretoken_array
from quire.session import scratch_path

BYTE_ID_OFFSET = 1
FIRST_MERGE_ID = 257


def byte_chars() -> list[str]:
    """Printable stand-in character per byte value (the published GPT-2 rule):
    printable Latin-1 bytes map to themselves, the others to U+0100 upwards in byte order."""
    keep = (list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1))
            + list(range(ord("®"), ord("ÿ") + 1)))
    out, extra = {}, 0
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


#: Pairs that a round chooses its merges from, and word types of a block.
CANDIDATES, BLOCK_TYPES = 4096, 2048


def next_merges(top: list[tuple[int, str, str]], rest: int) -> list[tuple[str, str]]:
    """The longest run of merges that is certain to come next, from the most frequent pairs ``top`` (count, a, b; in order of
    count descending, a, b); no other pair has more than ``rest`` occurrences.

    A merge changes the counts of those pairs only that begin with its end or end with its begin, and makes pairs that are no
    more frequent than one of these.  So pairs in order are safe up to the first such pair, if they are more
    frequent than it.  Pairs as frequent as it are safe, too, while every pair that may be made with that count comes later in order.
    A pair of equal symbols can make pairs of half its count by itself."""
    begins, ends, limit, run, bound = set(), set(), 0, [], rest
    for w, a, b in top:
        if run and (a in ends or b in begins or w <= limit):
            bound = w
            break
        run.append((w, a, b))
        begins.add(a)
        ends.add(b)
        if a == b:
            limit = max(limit, w // 2)
    tied = [(a, b) for w, a, b in top if w == bound]
    out, least = [], None
    for w, a, b in run:
        if out and w <= bound and (rest >= w or (least is not None and least < (a, b))):
            break
        out.append((a, b))
        for x, y in tied:
            for made in ((x, a + b) if y == a else None, (a + b, y) if x == b else None):
                if made is not None and (least is None or made < least):
                    least = made
    return out


def _blocks(types: DataFrame) -> DataFrame:
    """Word types (word, n) in blocks of flat arrays: sym (int32 ids of all symbols), lens (of each type), n."""
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_TYPES):
                part = batch.slice(i, BLOCK_TYPES)
                words = [(w or "").encode() for w in part.column(0).to_pylist()]
                lens = np.array([len(w) for w in words], np.int32)
                sym = np.frombuffer(b"".join(words), np.uint8).astype(np.int32) + BYTE_ID_OFFSET
                yield _block_batch([sym], [lens], [part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)])

    # one symbol never merges
    many = types.where(F.octet_length("word") > 1).select("word", "n")
    return many.mapInArrow(run, "sym binary, lens binary, n binary").withColumn("block", F.monotonically_increasing_id())


def _block_batch(*cols):
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in c], pa.binary()) for c in cols], names=["sym", "lens", "n"])


def _open(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, the type of each, n of each type, block number of each type) of the blocks of an Arrow batch."""
    get = lambda c, kind: [np.frombuffer(v, kind) for v in batch.column(c).to_pylist()]
    sym, lens, n = get("sym", np.int32), get("lens", np.int32), get("n", np.int64)
    flat = np.concatenate(lens)
    return (np.concatenate(sym).astype(np.int64), np.repeat(np.arange(len(flat)), flat), np.concatenate(n),
            np.repeat(np.arange(len(lens)), [len(x) for x in lens]))


def _apply(sym: np.ndarray, owner: np.ndarray, rounds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The merges of each round (rows: code of the pair, id; sorted) made in all types, from left to right."""
    for table in rounds:
        pair = sym[:-1] << 32 | sym[1:]
        at = np.minimum(np.searchsorted(table[:, 0], pair), len(table) - 1)
        hit = np.append((table[at, 0] == pair) & (owner[:-1] == owner[1:]), False)
        where = np.flatnonzero(hit)
        # only a pair of equal symbols can overlap itself: every other place of a run counts
        run = np.flatnonzero(hit & ~np.append(False, hit[:-1]))
        hit[where] = (where - run[np.searchsorted(run, where, "right") - 1]) % 2 == 0
        where = where[hit[where]]
        sym = sym.copy()
        sym[where] = table[at[where], 1]
        stay = ~np.append(False, hit[:-1])
        sym, owner = sym[stay], owner[stay]
    return sym, owner


def _count(sym, owner, n, block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, block, occurrences) of all adjacent pairs."""
    same = np.flatnonzero(owner[:-1] == owner[1:])
    pair, own = sym[same] << 32 | sym[same + 1], owner[same]
    return pair, block[own], n[own]


def _sums(ids, pair, block, w):
    """Occurrences added up by pair and block, those that are 0 left out."""
    order = np.lexsort((block, pair))
    pair, block, w = pair[order], block[order], w[order]
    if not len(pair):
        total = w
    else:
        starts = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (block[1:] != block[:-1])))
        total, pair, block = np.add.reduceat(w, starts), pair[starts], block[starts]
    some = total != 0
    return pa.RecordBatch.from_arrays([pa.array(pair[some]), pa.array(ids[block[some]]), pa.array(total[some])],
                                      names=["pair", "block", "w"])


_CHANGE = "pair long, block long, w long"


def _state(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks, pair counts by block: pair, block, w; sorted by pair, so that a reader skips other pairs), written."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield _sums(batch.column("block").to_numpy(zero_copy_only=False), *_count(*_open(batch)))

    blocks = write_table(blocks, "bpe-blocks")
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = blocks.mapInArrow(run, _CHANGE).repartitionByRange(n, "pair", "block").sortWithinPartitions("pair")
    return blocks, write_table(index, "bpe-index")


def fit_bpe(df: DataFrame, text_col: str = "text", num_merges: int = 50,
            pattern: str = GPT2_PATTERN, cut_every: int = 16) -> list[tuple[str, str]]:
    """Learn up to ``num_merges`` merges; returns them in order (a list bounded by the parameter).  Equal to a fit merge by merge."""
    from quire.sources.corpus import spread
    spark = df.sparkSession
    types = (spread(df.select(text_col)).select(F.explode(pretoken_array(text_col, pattern)).alias("word"))
             .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    blocks, index = _state(_blocks(types))
    names = [None, *byte_chars()]      # symbol of each id
    ids = {c: i for i, c in enumerate(names)}
    merges: list[tuple[str, str]] = []
    rounds: list[np.ndarray] = []      # merges of each round since the blocks were written
    changes = scratch_path(spark, "bpe-changes")
    a, b = F.shiftright("pair", 32), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))

    def changed(rounds: list[np.ndarray]):
        """Differences of the pair counts that the last of ``rounds`` makes in its blocks, played again from the written ones."""
        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                sym, owner, n, block = _open(batch)
                sym, owner = _apply(sym, owner, rounds[:-1])
                before = _count(sym, owner, n, block)
                after = _count(*_apply(sym, owner, rounds[-1:]), n, block)
                both = [np.concatenate([x, y]) for x, y in zip(before[:2], after[:2], strict=True)]
                yield _sums(batch.column("block").to_numpy(zero_copy_only=False), *both, np.concatenate([-before[2], after[2]]))
        return run

    def rewritten(rounds: list[np.ndarray]):
        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                sym, owner, n, block = _open(batch)
                sym, owner = _apply(sym, owner, rounds)
                lens = np.bincount(owner, minlength=len(n)).astype(np.int32)
                keep = lens > 1  # types that are one symbol by now
                sym, lens, n, block = sym[keep[owner]], lens[keep], n[keep], block[keep]
                cuts = np.searchsorted(block, np.arange(1, batch.num_rows))
                ends = np.append(0, np.cumsum(lens))[cuts]
                out = _block_batch(np.split(sym.astype(np.int32), ends), np.split(lens, cuts), np.split(n, cuts))
                yield pa.RecordBatch.from_arrays([*out.columns, batch.column("block")], names=[*out.schema.names, "block"])
        return run

    while len(merges) < num_merges:
        now = index
        if rounds:
            now = now.unionByName(spark.read.schema(_CHANGE).parquet(changes))
        counts = now.groupBy("pair").agg(F.sum("w").alias("w")).where("w > 0")
        rows = counts.orderBy(F.desc("w"), "pair").limit(CANDIDATES).collect()
        if not rows:
            break
        rest = rows[-1]["w"] if len(rows) == CANDIDATES else 0
        if rest == rows[0]["w"]:  # all are as frequent: the smallest of that count, wherever it is
            symbols = spark.createDataFrame([(i, s) for i, s in enumerate(names) if s], "id long, s string")  # as long as the merges
            tied = counts.where(F.col("w") == rest).select(a.alias("a"), b.alias("b"))
            for c in ("a", "b"):
                tied = tied.join(F.broadcast(symbols.withColumnRenamed("id", c).withColumnRenamed("s", "s" + c)), c)
            first = tied.orderBy("sa", "sb").limit(1).collect()[0]
            batch = [(first["sa"], first["sb"])]
        else:
            top = [(r["w"], names[r["pair"] >> 32], names[r["pair"] & 0xFFFFFFFF]) for r in rows if r["w"] > rest]
            batch = next_merges(sorted(top, key=lambda t: (-t[0], *t[1:])), rest)[:num_merges - len(merges)]
        merges += batch
        if len(merges) == num_merges:
            break
        for x, y in batch:
            ids[x + y] = len(names)
            names.append(x + y)
        rounds.append(np.array(sorted((ids[x] << 32 | ids[y], ids[x + y]) for x, y in batch), np.int64))
        wanted = now.where(F.col("pair").isin(rounds[-1][:, 0].tolist()) & (F.col("w") > 0)).select("block").distinct()
        if len(rounds) % cut_every:
            touched = blocks.join(wanted, "block", "left_semi").select("sym", "lens", "n", "block")
            touched.mapInArrow(changed(rounds), _CHANGE).write.mode("append").parquet(changes)
        else:
            blocks, index = _state(blocks.select("sym", "lens", "n", "block").mapInArrow(
                rewritten(rounds), "sym binary, lens binary, n binary, block long"))
            rounds, changes = [], scratch_path(spark, "bpe-changes")
    return merges


def symbol_ids(merges: list[tuple[str, str]]) -> dict[str, int]:
    """Id of every symbol."""
    ids = {c: b + BYTE_ID_OFFSET for b, c in enumerate(byte_chars())}
    for i, (a, b) in enumerate(merges):
        ids[a + b] = FIRST_MERGE_ID + i
    return ids


def merge_many(sym: np.ndarray, owner: np.ndarray, codes: np.ndarray, made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge the ids ``sym`` of many words (``owner``: the word of each, ascending), in each word the earliest merge first, from left to
    right.  ``codes``: sorted pairs (first << 32 | second), ``made``: their merged ids, which rise with the order of the merges."""
    done_sym, done_owner = [], []
    while len(sym):
        pair = sym[:-1] << 32 | sym[1:]
        at = np.minimum(np.searchsorted(codes, pair), len(codes) - 1)
        ok = (codes[at] == pair) & (owner[:-1] == owner[1:])
        rank = np.append(np.where(ok, made[at], np.iinfo(np.int64).max), np.iinfo(np.int64).max)
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        lens = np.diff(np.append(starts, len(sym)))
        best = np.repeat(np.minimum.reduceat(rank, starts), lens)
        idle = best == np.iinfo(np.int64).max
        done_sym.append(sym[idle])
        done_owner.append(owner[idle])
        hit = (rank == best) & ~idle
        # a run of equal symbols pairs up from the left: every other hit of a run of hits counts
        run = np.flatnonzero(hit & ~np.append(False, hit[:-1]))
        where = np.flatnonzero(hit)
        hit[where] = (where - run[np.searchsorted(run, where, "right") - 1]) % 2 == 0
        sym = np.where(hit, rank, sym)
        stay = ~np.append(False, hit[:-1]) & ~idle
        sym, owner = sym[stay], owner[stay]
    sym, owner = np.concatenate([*done_sym, sym]), np.concatenate([*done_owner, owner])
    order = np.argsort(owner, kind="stable")
    return sym[order], owner[order]


def encode_types(types: DataFrame, word_col: str, merges: list[tuple[str, str]], out_col: str = "ids") -> DataFrame:
    """``types`` with the ids of ``word_col``; the merges (a list bounded by the fit's parameter) are broadcast as two arrays."""
    ids = symbol_ids(merges)
    pairs = np.array([[ids[a], ids[b], ids[a + b]] for a, b in merges] or [[-1, -1, -1]], np.int64)
    codes = pairs[:, 0] << 32 | pairs[:, 1]
    order = np.argsort(codes)
    table = types.sparkSession.sparkContext.broadcast((codes[order], pairs[order, 2]))

    def run(batches):
        codes, made = table.value
        for b in batches:
            words = [(w or "").encode() for w in b.column(word_col).to_pylist()]
            lens = np.array([len(w) for w in words], np.int64)
            sym = np.frombuffer(b"".join(words), np.uint8).astype(np.int64) + BYTE_ID_OFFSET
            sym, owner = merge_many(sym, np.repeat(np.arange(len(words)), lens), codes, made)
            bounds = np.append(0, np.cumsum(np.bincount(owner, minlength=len(words))))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(sym.astype(np.int32)))],
                names=[*b.schema.names, out_col])

    return types.mapInArrow(run, types.select("*").schema.add(out_col, T.ArrayType(T.IntegerType())))


def bpe_encode(df: DataFrame, merges: list[tuple[str, str]], key_cols: list | None = None, text_col: str = "text",
               out_col: str = "ids", pattern: str = GPT2_PATTERN, hot_size: int = HOT_VOCAB) -> DataFrame:
    """Texts -> BPE ids; null and empty texts give none.  Word types are counted and encoded once; the frequent ones are a
    dictionary of bounded bytes, the others come back to their rows by a join.  Rows keep their own identity (``key_cols`` is not needed)."""
    from quire.sources.corpus import spread
    toks = spread(df).withColumn("_toks", pretoken_array(text_col, pattern)).drop(text_col)
    types = toks.select(F.explode("_toks").alias("_w")).groupBy("_w").agg(F.count(F.lit(1)).alias("_n"))
    ranked = with_global_index(write_table(types, "bpe-types"), [F.desc("_n"), "_w"], "_rank")
    table = write_table(encode_types(ranked.select("_w", "_rank"), "_w", merges, "_ids"), "bpe-type-ids")
    out = lookup(toks, "_toks", table, "_w", "_ids", "_rank", out_col, most=hot_size)
    return out.withColumn(out_col, F.flatten(out_col))
