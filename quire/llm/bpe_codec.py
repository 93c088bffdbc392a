"""BPE encoding and decoding (operator 8) by forced-boundary splitting.

A pair of neighbouring bytes that occurs inside no vocabulary token can never
be merged over, so a pre-token is cut between the two bytes of every such pair
and its fragments are encoded alone and concatenated.  The cuts in front of
blanks (``chunks``) come first; pre-tokens follow the tokenizer's own splitting rule.

Defined results: a null text counts as empty and has no ids; repeated rows are
encoded each; added tokens written in a text become their ids, as in the
library; any other columns are kept; texts of any length are encoded whole.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.chunks import ENCODE_BYTES, ChunkEncoder, FastChunks, id_column
from quire.llm.common import binary_array, ragged, slices
from quire.llm.merges import MergeTable

FRAGMENT_MEMO = 300_000
_SHORT = 24


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ForcedBoundaryBPE:
    """Merges of a byte-level BPE file, applied to fragments between forced boundaries."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        file = json.loads(spec)
        vocab = file["model"]["vocab"]
        self.vocab = vocab
        self.merges = {}
        for rank, m in enumerate(file["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        #: pairs of characters that stand inside some token; any other pair is a certain cut
        self.inside = {t[i:i + 2] for t in vocab for i in range(len(t) - 1)}
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") \
            if self.added else None
        # the file's own splitting rule; the merges are done here
        self.pre = Tokenizer.from_str(spec).pre_tokenizer.pre_tokenize_str
        self.memo: dict[str, list[int]] = {}

    def inside_bytes(self) -> np.ndarray:
        """``inside`` as a table of byte pairs."""
        back = {c: b for b, c in byte_alphabet().items()}
        table = np.zeros((256, 256), bool)
        for a, b in self.inside:
            if a in back and b in back:
                table[back[a], back[b]] = True
        return table

    def fragments(self, piece: str) -> list[str]:
        inside, out, at = self.inside, [], 0
        for i in range(1, len(piece)):
            if piece[i - 1:i + 1] not in inside:
                out.append(piece[at:i])
                at = i
        out.append(piece[at:])
        return out

    def encode(self, text: str) -> list[int]:
        if self.split_added is None:
            return self._plain(text)
        out: list[int] = []
        for part in self.split_added.split(text):
            if part in self.added:
                out.append(self.added[part])
            elif part:
                out.extend(self._plain(part))
        return out

    def _plain(self, text: str) -> list[int]:
        out: list[int] = []
        memo = self.memo
        for piece, _ in self.pre(text):
            for fragment in self.fragments(piece):
                ids = memo.get(fragment)
                if ids is None:
                    ids = self.merge(fragment)
                    if len(fragment) <= 64:
                        if len(memo) >= FRAGMENT_MEMO:
                            memo.clear()
                        memo[fragment] = ids
                out.extend(ids)
        return out

    def merge(self, fragment: str) -> list[int]:
        """Lowest rank first, leftmost first."""
        ids = [self.vocab[c] for c in fragment]
        if len(ids) > _SHORT:
            return self._merge_long(ids)
        merges = self.merges
        while len(ids) > 1:
            best = min(((merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in merges),
                       default=None)
            if best is None:
                break
            i = best[1]
            ids[i:i + 2] = [merges[ids[i], ids[i + 1]][1]]
        return ids

    def _merge_long(self, ids: list) -> list[int]:
        merges, n = self.merges, len(ids)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(merges[p][0], i, *p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in merges]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = merges[a, b][1], None
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
                if (ids[i], ids[k]) in merges:
                    heapq.heappush(heap, (merges[ids[i], ids[k]][0], i, ids[i], ids[k]))
            h = left[i]
            if h >= 0 and (ids[h], ids[i]) in merges:
                heapq.heappush(heap, (merges[ids[h], ids[i]][0], h, ids[h], ids[i]))
        return [x for x in ids if x is not None]


_CODECS: dict = {}


def _codec(spec: str) -> ChunkEncoder:
    key = hash(spec)
    if key not in _CODECS:
        bpe = ForcedBoundaryBPE(spec)
        symbols = np.array([bpe.vocab[c] for _, c in sorted(byte_alphabet().items())], np.uint32)
        # letters from C3 to C9 are all letters; U+00AA to U+00BA are left to the splitting rule
        _CODECS[key] = ChunkEncoder(FastChunks(MergeTable(bpe.merges), symbols, symbols, bpe.inside_bytes(),
                                               lambda chunks: [bpe.encode(c) for c in chunks],
                                               range(0xC3, 0xCA), words=False))
    return _CODECS[key]


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, spec_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col`` (binary, little-endian unsigned 32-bit ids) in place of the text.

    The vocabulary file is read on the driver and broadcast (a fixed size)."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(spec_path))
    keep = [c for c in docs.columns if c not in (text_col, ids_col)]
    schema = docs.select(*keep).schema.add(ids_col, "binary")

    def run(batches):
        codec = _codec(spec.value)
        for b in slices(batches, text_col, ENCODE_BYTES):
            ids, bounds = codec.encode(b.column(text_col))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), id_column(ids, bounds)],
                                             names=[*keep, ids_col])

    return docs.select(*keep, F.col(text_col).cast("string").alias(text_col)).mapInArrow(run, schema)


def _token_bytes(spec: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    file, back = json.loads(spec), {c: b for b, c in byte_alphabet().items()}
    words = {i: bytes(back[c] for c in t) for t, i in file["model"]["vocab"].items()}
    words |= {t["id"]: t["content"].encode() for t in file["added_tokens"]}
    parts = [words.get(i, b"") for i in range(max(words) + 1)]
    lens = np.array([len(p) for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lens) - lens, lens


def decode(coded: DataFrame, spec_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``coded`` with ``text_col``: the bytes of the ids' tokens (special tokens included) as text."""
    spec = coded.sparkSession.sparkContext.broadcast(read_spec(spec_path))
    keep = [c for c in coded.columns if c != text_col]
    schema = coded.select(*keep).schema.add(text_col, "string")

    def run(batches):
        flat, starts, lens = _token_bytes(spec.value)
        for b in slices(batches, ids_col):
            col = b.column(ids_col).cast(pa.large_binary())
            values = [np.frombuffer(v or b"", "<u4") for v in col.to_pylist()]
            ids = np.concatenate(values) if values else np.zeros(0, np.uint32)
            bounds = np.zeros(len(values) + 1, np.int64)
            np.cumsum([len(v) for v in values], out=bounds[1:])
            upto = np.zeros(len(ids) + 1, np.int64)
            np.cumsum(lens[ids], out=upto[1:])
            raw = binary_array(ragged(flat, starts[ids], lens[ids]), upto[bounds])
            try:
                text = raw.cast(pa.large_string())
            except pa.ArrowInvalid:  # ids that are no whole characters
                text = pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.large_string())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), text.cast(pa.string())],
                                             names=[*keep, text_col])

    return coded.select(*keep).mapInArrow(run, schema)
