"""Packing (operator 9): bounded-space online packing into fixed windows.

Every task keeps at most ``open_windows`` windows open.  A document's whole
windows leave at once; its rest goes to the open window that it fits best.
When it fits none and all windows are in use, the fullest one leaves, filled up
first with a piece cut from the rest if it lacks ``min_piece`` ids or more.  What
the tasks leave open is merged in rounds of ``fan_in`` tasks, until one open
window is left in all.

Defined results: a null text is empty and has the end id alone; repeated rows are
packed each; an empty table gives no rows; a document of any length is cut into windows.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.bpe_codec import byte_alphabet, read_spec
from quire.llm.chunks import ENCODE_BYTES, ChunkEncoder, FastChunks
from quire.llm.common import slices
from quire.llm.merges import MergeTable
from quire.operators.indexing import write_table

WINDOW, OPEN_WINDOWS, MIN_PIECE, FAN_IN, END_ID = 2048, 32, 16, 64, 1
_ROWS, _WORD_END = 50_000, "</w>"
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, owner long, ids binary")
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
_CODECS: dict = {}


def _library(spec: str) -> ChunkEncoder:
    key = hash(spec)
    if key not in _CODECS:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(spec)
        tok.no_padding()
        tok.no_truncation()
        vocab, file = tok.get_vocab(), json.loads(spec)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"]]
        merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        chars = [c for _, c in sorted(byte_alphabet().items())]
        first, last = (np.array([vocab[c + end] for c in chars], np.uint32) for end in ("", _WORD_END))
        # plain words by array operations, all others by the library itself
        _CODECS[key] = ChunkEncoder(FastChunks(
            MergeTable(merges), first, last, np.ones((256, 256), bool),
            lambda chunks: [e.ids for e in tok.encode_batch_fast(chunks, add_special_tokens=False)],
            range(0xC3, 0xC4), words=True))
    return _CODECS[key]


class Packer:
    """Open windows of one task; ``done`` collects rows of closed ones."""

    def __init__(self, first_id: int, window: int, open_windows: int, min_piece: int):
        self.next_id, self.window, self.most, self.min_piece = first_id, window, open_windows, min_piece
        self.open: list[list] = []  # [ids in it, pieces]
        self.done: list[tuple] = []

    def _close(self, pieces: list) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.done.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next_id, at, None, None))
            at += len(ids)
        self.next_id += 1

    def add(self, doc, ids: np.ndarray, start: int, total: int) -> None:
        w, at = self.window, 0
        while len(ids) - at >= w:
            self._close([(doc, start + at, ids[at:at + w], total)])
            at += w
        while at < len(ids):
            need = len(ids) - at
            best = max((x for x in self.open if x[0] + need <= w), key=lambda x: x[0], default=None)
            if best is None and len(self.open) < self.most:
                best = [0, []]
                self.open.append(best)
            if best is not None:
                best[0] += need
                best[1].append((doc, start + at, ids[at:].copy(), total))
                if best[0] == w:
                    self.open.remove(best)
                    self._close(best[1])
                return
            full = max(self.open, key=lambda x: x[0])
            gap = w - full[0]
            if gap >= self.min_piece:
                full[1].append((doc, start + at, ids[at:at + gap].copy(), total))
                at += gap
            self.open.remove(full)
            self._close(full[1])

    def left(self, owner: int) -> list[tuple]:
        """Rows of the windows that are still open: with ids, for the next round."""
        return [(doc, start, len(ids), zlib.crc32(ids.tobytes()), total, -1, k, owner, ids.tobytes())
                for k, (_, pieces) in enumerate(sorted(self.open, key=lambda x: -x[0]))
                for doc, start, ids, total in pieces]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 8 + [pa.binary()]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=_NAMES)


def pack(docs: DataFrame, spec_path: str, window: int = WINDOW, open_windows: int = OPEN_WINDOWS,
         min_piece: int = MIN_PIECE, end_id: int = END_ID, fan_in: int = FAN_IN) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(spec_path))

    def run(batches):
        codec, pid = _library(spec.value), TaskContext.get().partitionId()
        packer = Packer(pid << 32, window, open_windows, min_piece)
        for b in slices(batches, "text", ENCODE_BYTES):
            ids, bounds = codec.encode(b.column("text"))
            for k, doc in enumerate(b.column("doc_id").to_pylist()):
                own = np.append(ids[bounds[k]:bounds[k + 1]], np.uint32(end_id)).astype("<u4")
                packer.add(doc, own, 0, len(own))
                if len(packer.done) >= _ROWS:
                    yield _batch(packer.done)
                    packer.done = []
        yield _batch(packer.done + packer.left(pid))

    # written once: the closed windows and what is left open must come from the same run of a task
    first = write_table(docs.select("doc_id", F.col("text").cast("string").alias("text"))
                        .mapInArrow(run, SCHEMA), "packed")
    out, rest, turn = first.filter("owner is null"), first.filter("owner is not null"), 0
    while True:
        top = rest.agg(F.max("owner")).first()[0]
        if top is None:
            break
        last = top < fan_in
        merged = write_table(rest.withColumn("owner", F.floor(F.col("owner") / fan_in).cast("long"))
                             .groupBy("owner").applyInPandas(_merger(turn, window, min_piece, last), SCHEMA), "packed-rest")
        turn += 1
        out = out.unionByName(merged.filter("owner is null"))
        if last:
            break
        rest = merged.filter("owner is not null")
    return out.drop("owner", "ids")


def _merger(turn: int, window: int, min_piece: int, last: bool):
    """Packs what ``fan_in`` tasks left open into one open window (closed in the last round)."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        owner = int(pdf["owner"].iloc[0])
        packer = Packer((1 << 62) + (turn << 58) + (owner << 32), window, 1, 1)
        for r in pdf.sort_values(["length", "doc_id", "start"], ascending=[False, True, True]).itertuples():
            packer.add(None if pd.isna(r.doc_id) else int(r.doc_id), np.frombuffer(r.ids, "<u4"), int(r.start), int(r.doc_tokens))
        if last:
            for x in packer.open:
                packer._close(x[1])
            packer.open = []
        return _batch(packer.done + packer.left(owner)).to_pandas(integer_object_nulls=True)

    return merge
