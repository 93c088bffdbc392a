"""Suffix-array dedup (operator 2): bytes that lie in a repeated string of ``length`` bytes.

A suffix array of every byte would be many times the text, so it is sparse: a
window of ``length`` bytes is looked up by its anchor, the start of its GRAM-byte
substring of least hash (the leftmost such), which depends on the window's bytes
alone, so equal windows have equal anchors at equal places.  An anchor stands for
a run of neighbouring windows.

1. Anchors of all texts, with hashes of their gram and of all bytes of their windows.
   Equal bytes seen twice: all windows of the anchor are repeated.  A gram seen once: none is.
2. For grams with several surroundings, one suffix (the bytes from the anchor
   on) for each distinct surrounding takes part in a distributed merge sort: tasks sort their
   suffixes and send front-coded runs (shared prefix length and the rest), and a
   loser tree merges the runs of a partition without comparing known prefixes again.
   The merged common-prefix lengths, and those of the bytes before the anchors, give
   for each window start the suffixes that agree on all its bytes.
3. The repeated windows' bytes go, text by text.

A gram with more than ``hot`` surroundings leaves its windows to a count by
128-bit digest instead, which is pre-aggregated and has no group in one task.

Defined results: a null text is empty; texts shorter than ``length`` stay whole; repeated rows
are repeats of each other; a null id is a text like any other; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import mix, powers, slices, span_hashes, text_buffer
from quire.operators.indexing import write_table

LENGTH, GRAM, HOT, MERGED_AT_ONCE = 400, 64, 100_000, 20_000
_BLOCK, _RUN_BYTES = 1 << 17, 8 << 20
_BYTES = mix(np.arange(1001, 1257, dtype=np.uint64))
_STEP = mix(np.arange(51, 58, dtype=np.uint64)) | np.uint64(1)
_HIGH = np.uint64(0xFFFFFFFF00000000)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position, by doubling."""
    h, k, step = _BYTES[data], 1, 0
    while k < GRAM:
        h = h[:-k] * _STEP[step] + h[k:]
        k, step = 2 * k, step + 1
    return h


def anchors(data: np.ndarray, off: np.ndarray, length: int = LENGTH):
    """(first window start, last window start, anchor, gram hash, two hashes of all the windows' bytes)
    of the anchors of all texts, in blocks of bounded size."""
    width = length - GRAM + 1
    long_ = np.flatnonzero(np.diff(off) >= length)
    edge = np.zeros(len(data) + 1, np.int8)
    edge[off[long_]] += 1
    np.subtract.at(edge, off[long_ + 1] - length + 1, 1)
    valid = np.cumsum(edge[:-1], dtype=np.int8) > 0
    for x in range(0, max(len(data) - length + 1, 0), _BLOCK):
        d = data[x:x + _BLOCK + length - 1]
        ok = valid[x:x + len(d) - length + 1]
        starts = np.flatnonzero(ok)
        if not len(starts):
            continue
        grams = gram_hashes(d)
        n = len(grams)
        keys = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
        keys[:n] = (mix(grams) & _HIGH) | np.arange(n, dtype=np.uint64)
        rows = keys.reshape(-1, width)
        before = np.minimum.accumulate(rows, axis=1).ravel()
        after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(after[starts], before[starts + width - 1])
        at = (least & ~_HIGH).astype(np.int64)
        first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)))
        s0, s1 = starts[first], starts[np.append(first[1:], len(starts)) - 1]
        p, inv = powers(len(d) + 1)
        second = np.append(np.uint64(0), np.cumsum(_BYTES[d] * p[:len(d)]))
        c2 = mix((second[s1 + length] - second[s0]) * inv[s0])
        yield x + s0, x + s1, x + at[first], grams[at[first]], span_hashes(d, s0, s1 + length), c2


def _keyed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """text, the key of a text (id and hash: equal rows share it, and their fate), and the columns to keep."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").alias("k0"), text.alias("text"), F.struct(*keep).alias("row")).select(
        F.coalesce(F.col("k0").cast("long"), F.lit(0)).alias("k1"),
        F.xxhash64("text", F.col("k0").isNull()).alias("k2"), "text", "row")


def anchor_table(keyed: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for b in slices(batches, "text"):
            data, off = text_buffer(b.column("text"))
            k1, k2 = b.column("k1").to_numpy(), b.column("k2").to_numpy()
            for s0, s1, at, gram, c1, c2 in anchors(data, off, length):
                doc = np.searchsorted(off, s0, "right") - 1
                base = off[doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v) for v in (gram.view(np.int64), c1.view(np.int64), c2.view(np.int64), k1[doc], k2[doc],
                                           at - base, s0 - base, s1 - base)],
                    names=["gram", "c1", "c2", "k1", "k2", "at", "s0", "s1"])

    return keyed.select("k1", "k2", "text").mapInArrow(
        run, "gram long, c1 long, c2 long, k1 long, k2 long, at long, s0 long, s1 long")


# ---------------------------------------------------------------- runs

def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of ``a`` and ``b``, which agree on ``known`` bytes."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:  # a[known:low] agrees, a[known:high] does not
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def front_code(sorted_values: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """(length shared with the value before, rest) of sorted values."""
    shared = [0] * len(sorted_values)
    for i in range(1, len(sorted_values)):
        shared[i] = common_prefix(sorted_values[i - 1], sorted_values[i], 0)
    return np.array(shared, np.int64), [v[k:] for v, k in zip(sorted_values, shared, strict=True)]


class Run:
    """A front-coded sorted run, decoded value by value."""

    def __init__(self, shared, rests, items):
        self.shared, self.rests, self.items, self.i, self.value = shared, rests, items, -1, b""
        self.known = 0
        self.advance()

    def advance(self):
        self.i += 1
        if self.i < len(self.rests):
            self.known = int(self.shared[self.i])
            self.value = self.value[:self.known] + self.rests[self.i]
        else:
            self.value = None


def _beats(a: Run, b: Run) -> bool:
    """Whether ``a`` comes first.  ``known`` of both is what they share with the value put out last;
    the one that shares more comes first, and only equals are compared, from there on.
    The loser's ``known`` becomes what it shares with the winner."""
    if a.value is None or b.value is None:
        return b.value is None
    if a.known != b.known:
        return a.known > b.known
    k = common_prefix(a.value, b.value, a.known)
    first = a.value[k:k + 1] <= b.value[k:k + 1]
    if first:
        b.known = k
    else:
        a.known = k
    return first


def merge_runs(runs: list[Run]):
    """(value, length shared with the value before, item) of all runs in order, by a loser tree."""
    k = 1 << max(len(runs) - 1, 0).bit_length()
    leaves = [*runs, *(Run([], [], []) for _ in range(k - len(runs)))]
    for r in leaves:
        r.known = 0
    losers: list = [None] * k
    level = {k + i: r for i, r in enumerate(leaves)}
    for node in range(k - 1, 0, -1):
        a, b = level[2 * node], level[2 * node + 1]
        level[node], losers[node] = (a, b) if _beats(a, b) else (b, a)
    winner = level[1]
    place = {id(r): k + i for i, r in enumerate(leaves)}
    while winner.value is not None:
        yield winner.value, winner.known, winner.items[winner.i]
        winner.advance()
        node = place[id(winner)] // 2
        while node:
            if _beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2


def _runs(rows: list, parts: int):
    """Record batch of one front-coded run for each partition of the suffixes in ``rows``."""
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r[0] % parts, []).append(r)
    cols: list[list] = [[] for _ in range(8)]
    for part, own in sorted(by.items()):
        own.sort(key=lambda r: r[1])
        shared, rests = front_code([r[1] for r in own])
        row = (part, shared.astype("<i4").tobytes(), np.array([len(x) for x in rests], "<i4").tobytes(), b"".join(rests),
               np.array([len(r[2]) for r in own], "<i4").tobytes(), b"".join(r[2] for r in own),
               np.array([r[3:7] for r in own], "<i8").tobytes(), np.array([r[7] for r in own], bool).tobytes())
        for c, v in zip(cols, row, strict=True):
            c.append(v)
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=_RUN)


_RUN = ["part", "shared", "lens", "rests", "left_lens", "lefts", "meta", "known"]
_RUN_SCHEMA = "part long, " + ", ".join(f"{c} binary" for c in _RUN[1:])


def _cut(flat: bytes, lens: np.ndarray) -> list[bytes]:
    ends = np.cumsum(lens)
    return [flat[e - n:e] for e, n in zip(ends.tolist(), lens.tolist(), strict=True)]


def repeated_windows(rights: list[bytes], shared: np.ndarray, lefts: list[bytes], length: int):
    """For suffixes in sorted order with their shared lengths, and the reversed bytes before them:
    (suffix number, o) of every window that starts o bytes before its anchor and that another suffix has, too."""
    n = len(rights)
    order = sorted(range(n), key=lefts.__getitem__)
    lshared = np.zeros(n, np.int64)
    for i in range(1, n):
        lshared[i] = common_prefix(lefts[order[i - 1]], lefts[order[i]], 0)
    order = np.array(order)
    before, behind = np.array([len(x) for x in lefts]), np.array([len(x) for x in rights])
    low = np.maximum(length - behind, 0)  # the last window of an anchor starts so far before it
    for o in range(int(low.min()), int(before.max()) + 1):
        live = np.flatnonzero((low <= o) & (o <= before))
        if len(live) < 2:
            continue
        right = np.cumsum(shared < length - o)
        left = np.empty(n, np.int64)
        left[order] = np.cumsum(lshared < o)
        key = right[live] * (n + 1) + left[live]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        again = live[by[np.append(same, False) | np.append(False, same)]]
        if len(again):
            yield again, o


def _merger(length: int):
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        runs = []
        for r in pdf.itertuples():
            lens, left_lens = np.frombuffer(r.lens, "<i4"), np.frombuffer(r.left_lens, "<i4")
            items = zip(_cut(r.lefts, left_lens), np.frombuffer(r.meta, "<i8").reshape(-1, 4),
                        np.frombuffer(r.known, bool), strict=True)
            runs.append(Run(np.frombuffer(r.shared, "<i4"), _cut(r.rests, lens), list(items)))
        rights, shared, items = (list(x) for x in zip(*merge_runs(runs), strict=True))
        shared = np.array(shared, np.int64)
        shared[0] = 0
        meta = np.array([m for _, m, _ in items])
        known = np.array([k for _, _, k in items])
        who, o = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for again, k in repeated_windows(rights, shared, [x for x, _, _ in items], length):
            again = again[~known[again]]
            who.append(again)
            o.append(np.full(len(again), k))
        who, o = np.concatenate(who), np.concatenate(o)
        order = np.lexsort((-o, who))
        who, start = who[order], meta[who[order], 2] - o[order]
        first = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (start[1:] != start[:-1] + 1))) if len(who) else who
        last = np.append(first[1:], len(who)) - 1 if len(who) else who
        return pd.DataFrame({"k1": meta[who[first], 0], "k2": meta[who[first], 1], "low": start[first],
                             "high": start[last] + length})

    return merge


# ---------------------------------------------------------------- the operator

def repeated_ranges(keyed: DataFrame, length: int = LENGTH, hot: int = HOT, merged: int = MERGED_AT_ONCE) -> DataFrame:
    """k1, k2, low, high: byte ranges of texts that repeated windows cover (they may overlap)."""
    table = write_table(anchor_table(keyed, length), "anchors")
    # most grams are seen once and go no further; of the others one pass over the anchors says whether all surroundings are equal
    grams = table.groupBy("gram").agg(F.count(F.lit(1)).alias("seen"), F.min("c1").alias("a1"), F.max("c1").alias("b1"),
                                      F.min("c2").alias("a2"), F.max("c2").alias("b2")).filter("seen > 1")
    again = write_table(table.join(grams.select("gram", F.expr("a1 = b1 and a2 = b2").alias("equal")), "gram"), "repeated-grams")
    mixed = again.filter("not equal").drop("equal")
    kinds = mixed.groupBy("gram", "c1", "c2").agg(F.count(F.lit(1)).alias("n"))
    kinds = kinds.join(kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")), "gram")
    live = write_table(mixed.join(kinds, ["gram", "c1", "c2"]), "live-anchors")
    span = ["k1", "k2", F.col("s0").alias("low"), (F.col("s1") + length).alias("high")]
    whole = again.filter("equal").select(*span).unionByName(live.filter("n > 1").select(*span))

    # one text for each distinct surrounding of a gram that has several
    reps = live.groupBy("gram", "c1", "c2").agg(
        F.min(F.struct("k1", "k2", "at", "s0", "s1")).alias("r"), F.first("n").alias("n"), F.first("kinds").alias("kinds"))
    reps = write_table(reps.select("gram", "n", "kinds", "r.*").groupBy("k1", "k2").agg(
        F.collect_list(F.struct("at", "s0", "s1", "gram", "n", "kinds")).alias("reps")), "surroundings")
    total = reps.agg(F.sum(F.size("reps"))).first()[0] or 0
    parts = -(-total // merged)
    if not parts:
        return whole
    texts = keyed.select("k1", "k2", "text").join(reps, ["k1", "k2"]).dropDuplicates(["k1", "k2"])

    def surroundings(batches, wanted):
        for b in slices(batches, "text"):
            data, off = text_buffer(b.column("text"))
            k1, k2, col = b.column("k1").to_pylist(), b.column("k2").to_pylist(), b.column("reps")
            for i in range(b.num_rows):
                text = data[off[i]:off[i + 1]].tobytes()
                for r in col[i].as_py():
                    if wanted(r["kinds"]):
                        yield k1[i], k2[i], text, r

    def send(batches):
        rows, size = [], 0
        for a, b, text, r in surroundings(batches, lambda k: k <= hot):
            rows.append((r["gram"], text[r["at"]:r["s1"] + length], text[r["s0"]:r["at"]][::-1], a, b, r["at"], 0, r["n"] > 1))
            size += r["s1"] + length - r["s0"]
            if size >= _RUN_BYTES:
                yield _runs(rows, parts)
                rows, size = [], 0
        yield _runs(rows, parts)

    partly = (texts.mapInArrow(send, _RUN_SCHEMA).groupBy("part")
              .applyInPandas(_merger(length), "k1 long, k2 long, low long, high long"))
    out = whole.unionByName(partly)
    if not live.filter(F.col("kinds") > hot).isEmpty():
        out = out.unionByName(_by_digest(texts, surroundings, hot, length))
    return out


def _by_digest(texts: DataFrame, surroundings, hot: int, length: int) -> DataFrame:
    """Repeated windows of grams with more than ``hot`` surroundings: digests, counted with pre-aggregation."""

    def digests(batches):
        for a, b, text, r in surroundings(batches, lambda k: k > hot):
            d = np.frombuffer(text, np.uint8)[r["s0"]:r["s1"] + length]
            s = np.arange(r["s1"] - r["s0"] + 1)
            p, inv = powers(len(d) + 1)
            second = np.append(np.uint64(0), np.cumsum(_BYTES[d] * p[:len(d)]))
            w2 = mix((second[s + length] - second[s]) * inv[s])
            yield pa.RecordBatch.from_arrays(
                [pa.array(span_hashes(d, s, s + length).view(np.int64)), pa.array(w2.view(np.int64)),
                 pa.array(np.full(len(s), a)), pa.array(np.full(len(s), b)), pa.array(s + r["s0"])],
                names=["w1", "w2", "k1", "k2", "low"])

    rows = write_table(texts.mapInArrow(digests, "w1 long, w2 long, k1 long, k2 long, low long"), "window-digests")
    again = rows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w1", "w2")
    return rows.join(again, ["w1", "w2"], "left_semi").select("k1", "k2", "low", (F.col("low") + length).alias("high"))


def remove_repeats(docs: DataFrame, keep: list[str] = ("doc_id",), length: int = LENGTH, hot: int = HOT,
                   merged: int = MERGED_AT_ONCE) -> DataFrame:
    """row (struct of the ``keep`` columns), n_bytes, n_removed, n_spans and kept (binary: the remaining
    bytes) of every row of ``docs``."""
    keyed = _keyed(docs, list(keep))
    ranges = write_table(repeated_ranges(keyed, length, hot, merged), "repeated-ranges")
    by_text = ranges.groupBy("k1", "k2").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    schema = keyed.select("row").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")

    def run(batches):
        for b in slices(batches, "text"):
            data, off = text_buffer(b.column("text"))
            sizes = np.diff(off)
            step = np.zeros(len(data) + 1, np.int32)
            col = b.column("ranges")
            rows = np.repeat(np.arange(len(col)), col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            flat = col.flatten()
            np.add.at(step, off[rows] + flat.field("low").to_numpy(zero_copy_only=False).astype(np.int64), 1)
            np.add.at(step, off[rows] + flat.field("high").to_numpy(zero_copy_only=False).astype(np.int64), -1)
            gone = np.cumsum(step[:-1]) > 0
            upto = np.append(0, np.cumsum(gone))
            removed = upto[off[1:]] - upto[off[:-1]]
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            begins[off[:-1][sizes > 0]] = gone[off[:-1][sizes > 0]]
            runs = np.append(0, np.cumsum(begins))
            ends = np.append(0, np.cumsum(sizes - removed))
            kept = data[~gone].tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(sizes), pa.array(removed), pa.array(runs[off[1:]] - runs[off[:-1]]),
                 pa.array([kept[i:j] for i, j in zip(ends, ends[1:], strict=False)], pa.binary())],
                names=["row", "n_bytes", "n_removed", "n_spans", "kept"])

    return keyed.join(by_text, ["k1", "k2"], "left").select("row", "text", "ranges").mapInArrow(run, schema)
