"""N-gram Jaccard join (operator 3) over a token-group matrix.

Tokens are 64-bit hashes of word shingles.  Documents of equal sets are one
class.  Two sets that are similar enough share some tokens (SHARED, fewer for small sets) among
the first tokens of each, in any order of all tokens; here tokens come the later the more documents
have them (bitmaps of fixed size, one for each step of frequency, counted over all documents), so passages
that many documents share seldom bring documents together.  The smaller set of a pair needs a shorter prefix than
the larger one: a token outside the short prefix of both says nothing.

1. Similar documents are partitioned into groups: those with the same most
   common shared token, linked or not, in pieces of bounded size (which share two leading documents).  The members of a
   piece are compared with each other, and their links give first components.
2. The matrix has a row for each token and piece of that token's documents.  A
   document queries the pieces that it shares tokens with and that hold another component than its own; a piece's
   token union bounds the overlap with any member, and only a piece whose bound reaches the
   threshold is opened and compared.  Between two pieces the documents of one ask, those of the smaller group.
3. Components of all links.  A link inside a first component is not needed.

Defined results: null or blank text has an empty set and is linked with
nothing; fewer words than a shingle are one shingle; a null id takes no part (its
component is null); repeated rows appear each; an empty table gives no rows; other columns are
ignored; texts of any length are used whole.
"""

from __future__ import annotations

from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import SLICE_BYTES, give_back, lower_ascii, mix, slices, spans, text_buffer, word_hashes
from quire.llm.components import components
from quire.operators.indexing import write_table

#: Documents from which a token counts as frequent, bits of the largest bitmap, documents in a group's piece, queries at
#: once, and tokens that similar sets must share among their first ones (one for every SHARE_EACH of a set, if that is less).
FREQUENT, BITMAP_BITS, PIECE, QUERIES_AT_ONCE, SHARED, SHARE_EACH = 8, 26, 256, 1024, 8, 16
#: Steps of frequency, each four times the one before (so its bitmap needs a quarter of the entries).
STEPS = 6
#: Tokens of a group's piece, beyond which a group has more pieces.
PIECE_TOKENS = 1 << 20
#: Bits of a 32-bit key inside its bucket, tokens counted before a task hands them on, words of a bitmap's segment.
_KEY_BITS, _FLUSH, _SEGMENT = 22, 4_000_000, 1 << 13
_SLICE = SLICE_BYTES
_C = mix(np.arange(11, 43, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(data: np.ndarray, off: np.ndarray, words: int):
    """The sorted distinct shingle hashes of every text, in order."""
    n = len(off) - 1
    low = lower_ascii(data)
    starts, ends, doc = spans(~((low == 32) | ((low - np.uint8(9)) < 5)), off)
    h = word_hashes(low, starts, ends)
    many = np.bincount(doc, minlength=n)
    at = np.cumsum(many) - many
    full = max(len(h) - words + 1, 0)
    sh = np.full(full, words, np.uint64)
    for k in range(words):
        sh += h[k:k + full] * _C[k]
    sh = mix(sh)
    for i in range(n):
        m, a = int(many[i]), int(at[i])
        if m >= words:
            s = np.sort(sh[a:a + m - words + 1])
            yield s[np.append(True, s[1:] != s[:-1])]
        elif m:
            yield mix((h[a:a + m] * _C[:m]).sum(keepdims=True) + np.uint64(m))
        else:
            yield h[:0]


def needed(n, percent: int):
    """Least overlap of a set of ``n`` with any set that it is similar to."""
    return (percent * n + 99) // 100


def needed_of_smaller(n, percent: int):
    """Least overlap of a set of ``n`` with any similar set that is not smaller."""
    return (2 * percent * n + 99 + percent) // (100 + percent)


# ---------------------------------------------------------------- frequent tokens

def _packed(keys: list) -> pa.RecordBatch:
    """Counts of the tokens of one task, by bucket: steps between sorted 32-bit keys, and counts up to 255."""
    s = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint32)
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.zeros(0, np.int64)
    counts = np.minimum(np.diff(np.append(first, len(s))), 255).astype(np.uint8)
    s = s[first]
    edges = np.searchsorted(s, np.arange((1 << 32 - _KEY_BITS) + 1, dtype=np.uint64) << np.uint64(_KEY_BITS))
    rows = []
    for k, (i, j) in enumerate(zip(edges, edges[1:], strict=False)):
        if j > i:
            steps = np.diff(s[i:j] & np.uint32((1 << _KEY_BITS) - 1), prepend=np.uint32(0))
            rows.append((k, (steps.astype("<u2") if steps.max() < 65536 else steps.astype("<u4")).tobytes(), counts[i:j].tobytes()))
    cols = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())],
                                      names=["bucket", "steps", "counts"])


def _steps(bits: int) -> list[tuple[int, int]]:
    """(first entry, entries) of each step's bitmap, one after the other."""
    sizes = [1 << max(bits - 2 * k, 6) for k in range(STEPS)]
    return [(sum(sizes[:k]), n) for k, n in enumerate(sizes)]


def frequent_tokens(docs: DataFrame, words: int, least: int, bits: int) -> np.ndarray:
    """Bitmaps of ``_steps``: set in step ``k`` for every token that at least ``least * 4 ** k`` rows have
    (and for tokens that share its entry: a token taken for frequent only comes later in the order)."""

    def count(batches):
        held, size = [], 0
        for b in slices(batches, "text", _SLICE):
            for s in shingle_sets(*text_buffer(b.column("text")), words):
                held.append((s >> np.uint64(32)).astype(np.uint32))
                size += len(s)
            if size >= _FLUSH:
                yield _packed(held)
                held, size = [], 0
        yield _packed(held)

    def marks(bucket, counts):
        keys = np.flatnonzero(counts >= least)
        n, keys = counts[keys].astype(np.int64), keys + (bucket << _KEY_BITS)
        return _words(np.concatenate([start + (keys[n >= least << 2 * k] & (size - 1))
                                      for k, (start, size) in enumerate(_steps(bits))]))

    def add(batches):
        bucket, counts = None, np.zeros(1 << _KEY_BITS, np.uint32)  # every key of one bucket: a fixed size
        for b in batches:
            for k, s, c in zip(*(b.column(n).to_pylist() for n in ("bucket", "steps", "counts")), strict=True):
                if k != bucket:
                    if bucket is not None:
                        yield marks(bucket, counts)
                    bucket = k
                    counts.fill(0)
                n = np.frombuffer(c, np.uint8)
                counts[np.cumsum(np.frombuffer(s, "<u2" if len(s) == 2 * len(n) else "<u4"), dtype=np.int64)] += n
        if bucket is not None:
            yield marks(bucket, counts)
        del counts
        give_back()

    rows = (docs.select("text").mapInArrow(count, "bucket int, steps binary, counts binary")
            .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(add, _WORDS))
    start, size = _steps(bits)[-1]
    return _collected(rows, start + size)


def frequency(bitmaps: np.ndarray, bits: int, tokens: np.ndarray) -> np.ndarray:
    """How many steps of frequency each token has passed."""
    out, at = np.zeros(len(tokens), np.int8), np.arange(len(tokens))
    for start, size in _steps(bits):
        entry = (tokens[at] >> np.uint64(32)) & np.uint64(size - 1)
        at = at[_marked(bitmaps, entry + np.uint64(start))]
        out[at] += 1
    return out


def shared_by(n: int) -> int:
    """Tokens that a set of ``n`` has among its first ones in common with any similar set that is not smaller."""
    return min(max(n // SHARE_EACH, 1), SHARED)


def first_tokens(tokens: np.ndarray, bitmaps: np.ndarray, bits: int, percent: int) -> np.ndarray:
    """So many tokens of a set, rare ones first, that any similar set has ``shared_by`` (of the smaller set) of them
    among its own first ones."""
    p = min(len(tokens) - needed(len(tokens), percent) + shared_by(len(tokens)), len(tokens))
    return tokens[np.argsort(frequency(bitmaps, bits, tokens), kind="stable")[:p]]


# ---------------------------------------------------------------- sets

def sketches(docs: DataFrame, bitmaps: np.ndarray, bits: int, words: int, percent: int) -> DataFrame:
    """doc_id, n (set size), f1 and f2 (fingerprint of the set), first (its first tokens, in order), short (how many
    of them matter for sets that are not smaller)."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmaps)

    def run(batches):
        for b in slices(batches, "text", _SLICE):
            n, f1, f2, first, short = [], [], [], [], []
            for s in shingle_sets(*text_buffer(b.column("text")), words):
                n.append(len(s))
                f1.append(s.sum(dtype=np.uint64))
                f2.append(np.bitwise_xor.reduce(mix(s)) if len(s) else np.uint64(0))
                first.append(first_tokens(s, shared.value, bits, percent) if len(s) else s)
                short.append(len(s) - needed_of_smaller(len(s), percent) + shared_by(len(s)))
            ends = np.append(0, np.cumsum([len(x) for x in first]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(np.array(f1, np.uint64).view(np.int64)),
                 pa.array(np.array(f2, np.uint64).view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(first).view(np.int64))),
                 pa.array(short, pa.int64())], names=["doc_id", "n", "f1", "f2", "first", "short"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, f1 long, f2 long, first array<long>, short long")


def texts_of(docs: DataFrame, wanted: DataFrame, bits: int) -> DataFrame:
    """doc, text (compressed) of the documents in ``wanted`` (column doc), and of a few others: a bitmap of
    fixed size keeps most other texts out of the exchange that follows."""
    mask = np.uint64((1 << bits) - 1)

    def mark(batches):
        for b in batches:
            at = np.unique(mix(b.column("doc").to_numpy().astype(np.uint64)) & mask).astype(np.int64)
            yield _words(at)

    marks = _collected(wanted.select("doc").distinct().mapInArrow(mark, _WORDS), 1 << bits)
    shared = docs.sparkSession.sparkContext.broadcast(marks)

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in slices(batches, "text"):
            known = b.filter(b.column("doc").is_valid())
            at = mix(known.column("doc").to_numpy().astype(np.uint64)) & mask
            known = known.filter(pa.array(_marked(shared.value, at)))
            texts = [pack((t or "").encode()) for t in known.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([known.column("doc"), pa.array(texts, pa.binary())], names=["doc", "text"])

    return docs.select(F.col("doc_id").alias("doc"), "text").mapInArrow(run, "doc long, text binary")


def repeated_posts(reps: DataFrame, bits: int) -> DataFrame:
    """token, docs (how many have it), doc, short of the first tokens that several of ``reps`` (doc_id, first, short) have, one of them at
    least in its short prefix."""
    posts = reps.select(F.posexplode("first").alias("place", "token"), "short")
    repeated = posts.groupBy("token").agg(F.count(F.lit(1)).alias("docs"), F.max(F.col("place") < F.col("short")).alias("some"))
    repeated = write_table(repeated.filter("docs > 1 and some").select("token", "docs"), "repeated-tokens")
    mask = np.uint64((1 << bits) - 1)

    def mark(batches):
        for b in batches:
            yield _words(np.unique(b.column("token").to_numpy().view(np.uint64) & mask).astype(np.int64))

    # a bitmap of fixed size keeps most other tokens out of the join
    shared = reps.sparkSession.sparkContext.broadcast(_collected(repeated.select("token").mapInArrow(mark, _WORDS), 1 << bits))

    def run(batches):
        for b in batches:
            tokens = b.column("first").flatten().to_numpy(zero_copy_only=False)
            many = b.column("first").value_lengths().to_numpy()
            docs, short = (np.repeat(b.column(c).to_numpy(), many) for c in ("doc_id", "short"))
            short = np.arange(len(docs)) - np.repeat(np.cumsum(many) - many, many) < short
            keep = _marked(shared.value, tokens.view(np.uint64) & mask)
            yield pa.RecordBatch.from_arrays([pa.array(tokens[keep]), pa.array(docs[keep]), pa.array(short[keep])],
                                             names=["token", "doc", "short"])

    return reps.select("doc_id", "first", "short").mapInArrow(run, "token long, doc long, short boolean").join(
        repeated, "token")


_WORDS = "word long, bits long"


def _words(at: np.ndarray) -> pa.RecordBatch:
    """Entries of a bitmap as words of 64."""
    word, where = np.unique(at >> 6, return_inverse=True)
    marks = np.zeros(len(word), np.int64)
    np.bitwise_or.at(marks, where, np.left_shift(np.int64(1), at & 63))
    return pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(marks, pa.int64())], names=["word", "bits"])


def _collected(rows: DataFrame, entries: int) -> np.ndarray:
    """A bitmap of so many entries from rows of words; it reaches the driver as a few long segments."""
    size = min((entries + 63) // 64, _SEGMENT)
    n = -(-((entries + 63) // 64) // size) * size

    def join(pdf):
        marks = np.zeros(size, np.int64)
        np.bitwise_or.at(marks, pdf["word"].to_numpy(np.int64) % size, pdf["bits"].to_numpy(np.int64))
        return pd.DataFrame({"segment": [int(pdf["word"].iloc[0]) // size], "marks": [marks.tobytes()]})

    words = np.zeros(n, np.uint64)
    for r in (rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).groupBy(F.floor(F.col("word") / size))
              .applyInPandas(join, "segment long, marks binary").collect()):
        words[r["segment"] * size:(r["segment"] + 1) * size] = np.frombuffer(r["marks"], np.uint64)
    return words


def _marked(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0


class Incidence:
    """Members of a group by token: overlaps of one set with all of them in one pass."""

    def __init__(self, sets: list):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate(sets)
        self.union = np.unique(tokens)
        self.where = np.searchsorted(self.union, tokens).astype(np.int32)
        self.at = np.cumsum(self.sizes) - self.sizes

    def common(self, s: np.ndarray) -> np.ndarray:
        """Places in the token union of what ``s`` has in common with it."""
        at = np.minimum(np.searchsorted(self.union, s), len(self.union) - 1)
        return at[self.union[at] == s]

    def overlaps(self, common: np.ndarray) -> np.ndarray:
        mark = np.zeros(len(self.union), np.int32)
        mark[common] = 1
        return np.add.reduceat(mark[self.where], self.at)

    def linked(self, n: int, overlaps: np.ndarray, percent: int) -> np.ndarray:
        return 100 * overlaps >= percent * (self.sizes + n - overlaps)


def _unpacked(batches, words: int):
    """(group, component, doc, asks, set) of every row, in order; texts are opened a few at a time."""
    unpack = zstandard.ZstdDecompressor().decompress

    def sets(rows):
        texts = pa.array([unpack(r.pop()) for r in rows], pa.large_binary())
        return zip(rows, shingle_sets(*text_buffer(texts), words), strict=True)

    held, size = [], 0
    for b in batches:
        for g1, g2, comp, doc, ask, text in zip(
                *(b.column(c).to_pylist() for c in ("g1", "g2", "component", "doc", "asks", "text")), strict=True):
            held.append([(g1, g2), comp, doc, ask, text])
            size += zstandard.frame_content_size(text)
            if size >= _SLICE:
                for row, s in sets(held):
                    yield (*row, s)
                held, size = [], 0
    for row, s in sets(held):
        yield (*row, s)


def _edges(rows: list) -> pa.RecordBatch:
    a, b = zip(*rows, strict=True) if rows else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _dealt(rows: DataFrame) -> DataFrame:
    return (rows.select("g1", F.col("g2").cast("long").alias("g2"), "asks", "component", "doc", "text").repartition("g1", "g2")
            .sortWithinPartitions("g1", "g2", "asks"))  # members first, so that queries need not be held


def links_in_groups(members: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) that connect what is linked inside each group ``g1``, ``g2`` of ``doc``, ``text``."""

    def run(batches):
        out = []
        for _, rows in groupby(_unpacked(batches, words), itemgetter(0)):
            _, _, docs, _, sets = zip(*rows, strict=True)
            if len(docs) < 2:
                continue
            inc, root = Incidence(sets), np.arange(len(docs))
            for i, s in enumerate(sets):
                ok = inc.linked(len(s), inc.overlaps(inc.common(s)), percent)
                for j in np.flatnonzero(ok & (root != root[i])):
                    if root[j] != root[i]:
                        out.append((docs[i], docs[j]))
                        root[root == root[j]] = root[i]
            if len(out) > 10_000:
                yield _edges(out)
                out = []
        yield _edges(out)

    return _dealt(members.withColumn("asks", F.lit(False)).withColumn("component", F.col("doc"))).mapInArrow(run, "a long, b long")


def links_to_groups(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Links of queries with members of other components (one link for each such component), in groups ``g1``, ``g2``
    of ``asks`` (boolean), ``component``, ``doc``, ``text``."""

    def run(batches):
        out = []
        for _, rows in groupby(_unpacked(batches, words), itemgetter(0)):
            inc, comps, docs, sets = None, [], [], []
            for _, comp, doc, ask, s in rows:
                if not ask:
                    comps.append(comp)
                    docs.append(doc)
                    sets.append(s)
                    continue
                if not docs:
                    break
                if inc is None:
                    inc, sets, comps = Incidence(sets), None, np.array(comps, np.int64)
                common = inc.common(s)
                if len(common) < needed(len(s), percent):
                    continue  # no member can reach the threshold
                hit = np.flatnonzero(inc.linked(len(s), inc.overlaps(common), percent))
                hit = hit[comps[hit] != comp]
                out.extend((doc, docs[hit[j]]) for j in np.unique(comps[hit], return_index=True)[1])
                if len(out) > 10_000:
                    yield _edges(out)
                    out = []
        yield _edges(out)

    return _dealt(rows).mapInArrow(run, "a long, b long")


def join_similar(docs: DataFrame, words: int = 4, percent: int = 85, frequent: int = FREQUENT,
                 bits: int = BITMAP_BITS, piece: int = PIECE, at_once: int = QUERIES_AT_ONCE) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bitmaps = frequent_tokens(docs, words, frequent, bits)
    sets = write_table(sketches(docs, bitmaps, bits, words, percent), "sketches")

    # one document stands for all of equal sets
    live = sets.filter("n > 0 and doc_id is not null")
    classes = live.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"))
    reps = live.select("doc_id", "n", "first", "short").join(
        classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    shared = write_table(repeated_posts(reps, bits), "shared-tokens")

    # groups of similar documents
    pivots = shared.groupBy("doc").agg(F.max(F.struct("docs", "token"))["token"].alias("g1"))
    pivots = write_table(pivots.join(reps.select(F.col("doc_id").alias("doc"), "n"), "doc"), "pivots")
    groups = pivots.groupBy("g1").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("tokens"),
                                      F.min("doc").alias("lead1"), F.max("doc").alias("lead2"))
    groups = groups.filter("size > 1").withColumn(
        "pieces", F.ceil(F.greatest(F.col("size") / piece, F.col("tokens") / PIECE_TOKENS)).cast("int"))
    members = pivots.join(groups, "g1").select("g1", F.pmod(F.xxhash64("doc"), "pieces").cast("int").alias("g2"), "doc")
    leads = groups.select("g1", "lead1", "lead2", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("g2")).select(
        "g1", "g2", F.explode(F.array("lead1", "lead2")).alias("doc"))
    members = members.unionByName(leads).distinct()
    inner = write_table(links_in_groups(_with_text(members, docs, bits), words, percent), "links")
    found = components(inner)

    # the matrix: pieces by token, where a token has documents of several components
    homes = pivots.join(groups.select("g1", "size", "pieces"), "g1", "left").select(
        "doc", "n", "g1", F.coalesce("size", F.lit(1)).alias("size"),
        F.pmod(F.xxhash64("doc"), F.coalesce("pieces", F.lit(1))).cast("int").alias("g2"))
    homes = write_table(homes.join(found.select(F.col("node").alias("doc"), "component"), "doc", "left").withColumn(
        "component", F.coalesce("component", "doc")), "homes")
    placed = shared.join(homes, "doc")
    mixed = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    placed = write_table(placed.join(mixed.select("token"), "token", "left_semi"), "placed")
    matrix = placed.groupBy("token", F.col("g1").alias("to1"), F.col("g2").alias("to2")).agg(
        F.first("size").alias("to_size"), F.min("n").alias("n_low"), F.max("n").alias("n_high"),
        F.min(F.when(F.col("short"), F.col("n"))).alias("n_short"),
        F.min("component").alias("c_low"), F.max("component").alias("c_high"))
    asks = F.struct("size", "g1", "g2") < F.struct(F.col("to_size").alias("size"), F.col("to1").alias("g1"), F.col("to2").alias("g2"))
    others = (F.col("c_low") != F.col("component")) | (F.col("c_high") != F.col("component"))
    fits = (100 * F.col("n_high") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("n_low"))
    # the token is in the short prefix of the document, or of a member that is not larger
    tells = F.col("short") & (F.col("n_high") >= F.col("n")) | F.coalesce(F.col("n_short") <= F.col("n"), F.lit(False))
    enough = F.greatest(F.lit(1), F.least(F.lit(SHARED), F.floor(F.least("n", "n_low") / SHARE_EACH)))
    asked = write_table(placed.join(matrix, "token").filter(asks & others & fits & tells)
                        .groupBy(F.col("to1").alias("g1"), F.col("to2").alias("part"), "doc", "n", "component")
                        .agg(F.count(F.lit(1)).alias("common"), F.min("n_low").alias("n_low"))
                        .filter(F.col("common") >= enough).select("g1", "part", "doc", "component"), "asked")
    opened = asked.groupBy("g1", "part").agg(F.ceil(F.count(F.lit(1)) / at_once).cast("int").alias("lots"))
    slot = lambda lot: F.col("part").cast("long") * 65536 + lot
    queries = asked.join(opened, ["g1", "part"]).select(
        "g1", slot(F.pmod(F.xxhash64("doc"), "lots")).cast("long").alias("g2"), F.lit(True).alias("asks"), "doc", "component")
    answers = homes.select("g1", F.col("g2").alias("part"), "doc", "component").join(opened, ["g1", "part"]).select(
        "g1", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), "part", "doc", "component").select(
        "g1", slot(F.col("lot")).cast("long").alias("g2"), F.lit(False).alias("asks"), "doc", "component")
    outer = links_to_groups(_with_text(queries.unionByName(answers), docs, bits), words, percent)
    roots = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = components(roots.unionByName(outer))

    return _labelled(sets, classes, final)


def _with_text(rows: DataFrame, docs: DataFrame, bits: int) -> DataFrame:
    rows = write_table(rows, "group-rows")
    return rows.join(texts_of(docs, rows, bits).dropDuplicates(["doc"]), "doc")


def _labelled(sets: DataFrame, classes: DataFrame, final: DataFrame) -> DataFrame:
    label = classes.join(final.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "f1", "f2", F.coalesce("component", "rep").alias("component_id"))
    some = sets.filter("n > 0").select("doc_id", "n", "f1", "f2").join(label, ["f1", "f2"], "left")
    none = sets.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    out = some.select("doc_id", "n", "component_id").unionByName(none)
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
