"""Text to token ids over whole Arrow slices.

A text is cut before every space or line feed that follows a character which is
certainly no white space.  No pre-token and no added token of the two
tokenizers spans such a cut, so the chunks can be encoded alone, and equal
chunks of a slice only once (dictionary encoding in Arrow).  Nothing is kept from
slice to slice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from quire.llm.common import binary_array, ragged, text_buffer
from quire.llm.merges import MergeTable, merge_all

#: Text bytes encoded at once.
ENCODE_BYTES = 1 << 20


def chunk_bounds(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Start positions of all chunks of all texts."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    cut = np.zeros(n, bool)
    blank = (data == 32) | (data == 10)
    # the character before: printable ASCII, a two-byte one (C3-DF) or a three-byte one (E4-EF);
    # all white space beyond ASCII starts with C2, E1, E2 or E3
    safe = np.zeros(n, bool)
    safe[1:] = (data[:-1] > 32) & (data[:-1] < 127)
    safe[2:] |= (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF)
    safe[3:] |= (data[:-3] >= 0xE4) & (data[:-3] <= 0xEF) & (data[2:-1] >= 128)
    cut = blank & safe
    cut[off[:-1][off[:-1] < off[1:]]] = True
    return np.flatnonzero(cut)


class FastChunks:
    """Encodes many plain chunks with array operations, any other with ``odd(list of texts)``.

    Plain: printable ASCII and Latin letters (``leads``: their first UTF-8 bytes)
    behind at most one blank, without apostrophes, added tokens or long runs.
    ``first`` maps a byte to its symbol, ``last`` to its symbol at the end of a
    pre-token.  ``inside``: byte pairs that stand inside some token; between
    all others a fragment ends.  ``words``: blanks are dropped, letters
    lower-cased and digits alone; else a blank belongs to what follows.
    """

    LONGEST = 48

    def __init__(self, table: MergeTable, first, last, inside, odd, leads: range, words: bool):
        self.table, self.first, self.last, self.inside = table, first, last, inside
        self.odd, self.words = odd, words
        kind = np.zeros(256, np.uint8)  # 0: not plain, 1 letter, 2 digit, 3 other
        kind[33:127] = 3
        kind[48:58] = 2
        kind[65:91] = kind[97:123] = 1
        kind[0x80:0xC0] = kind[leads.start:leads.stop] = 1
        kind[39] = 0
        self.kind = kind

    def _plain(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        kind = self.kind[data]
        bad = kind == 0
        starts = off[:-1]
        lead = np.isin(data[starts], (10, 32))
        bad[starts[lead]] = False
        nxt = np.append(data[1:], np.uint8(0))
        bad |= (data == 0xC3) & ((nxt == 0x97) | (nxt == 0xB7))  # the signs among the letters
        bad |= (data == 60) & (nxt == 124)  # an added token may begin
        ok = np.add.reduceat(bad, starts) == 0
        return ok & (np.diff(off) <= self.LONGEST)

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = self._plain(data, off)
        counts = np.zeros(len(ok), np.int64)
        odd = np.flatnonzero(~ok)
        others = [np.asarray(x, np.uint32) for x in
                  self.odd([data[off[i]:off[i + 1]].tobytes().decode("utf-8") for i in odd])]
        counts[odd] = [len(x) for x in others]
        plain = np.flatnonzero(ok)
        ids, owner = self._encode(data, off, plain)
        counts[plain] = np.bincount(owner, minlength=len(plain))
        at = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.uint32)
        out[np.repeat(at[plain], counts[plain]) + _within(counts[plain])] = ids
        if len(odd):
            out[np.repeat(at[odd], counts[odd]) + _within(counts[odd])] = np.concatenate(others)
        return out, counts

    def _encode(self, data, off, plain):
        lens = (off[1:] - off[:-1])[plain]
        own = np.repeat(np.arange(len(plain)), lens)
        data = ragged(data, off[:-1][plain], lens)
        head = np.zeros(len(data), bool)
        head[np.cumsum(lens) - lens] = True
        blank = head & ((data == 32) | (data == 10))
        if self.words:
            keep = ~blank
            head |= np.append(False, blank[:-1])
            data, own, head = data[keep], own[keep], head[keep]
            latin = np.append(False, data[:-1] == 0xC3) & (data >= 0x80) & (data <= 0x9E)
            data = data + (((((data - np.uint8(65)) < 26) | latin).astype(np.uint8)) << 5)
        if not len(data):
            return np.zeros(0, np.uint32), own
        kind = self.kind[data]
        border = head.copy()
        border[1:] |= kind[1:] != kind[:-1]
        if self.words:
            border[1:] |= (kind[1:] == 2) & (kind[:-1] == 2)
        else:
            space = np.append(False, (blank & (data == 32))[:-1])
            border &= ~(space & ~head)
        end = np.append(border[1:], True)
        sym = np.where(end, self.last[data], self.first[data])
        border[1:] |= ~self.inside[data[:-1], data[1:]]  # forced boundaries
        sym, seg = merge_all(self.table, sym, np.cumsum(border))
        owner = own[np.flatnonzero(border)][seg - 1]
        return sym, owner


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. for each count."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


class ChunkEncoder:
    """Encodes slices of texts with ``encode_many(bytes, offsets of chunks) -> (ids of all, number of each)``."""

    def __init__(self, encode_many):
        self.encode_many = encode_many

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds: text i has ``ids[bounds[i]:bounds[i + 1]]``)."""
        data, off = text_buffer(texts)
        cuts = chunk_bounds(data, off)
        bounds = np.zeros(len(off), np.int64)
        if not len(cuts):
            return np.zeros(0, np.uint32), bounds
        coded = binary_array(data, np.append(cuts, len(data))).dictionary_encode()
        ids, counts = self.encode_many(*text_buffer(coded.dictionary))
        which = coded.indices.to_numpy(zero_copy_only=False)
        lens = counts[which]
        upto = np.zeros(len(lens) + 1, np.int64)
        np.cumsum(lens, out=upto[1:])
        return ragged(ids, (np.cumsum(counts) - counts)[which], lens), upto[np.searchsorted(cuts, off, "left")]


def id_column(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Ids as little-endian unsigned 32-bit integers, one binary value a text."""
    return binary_array(ids.astype("<u4").view(np.uint8), bounds * 4).cast(pa.binary())
