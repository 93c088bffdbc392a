"""Byte-pair merges for many fragments at once, as array operations.

All fragments advance together: in each step every unfinished fragment merges
its leftmost pair of lowest rank, so a step costs a few passes over the symbols
that are left, and the number of steps is that of the longest fragment's merges.
"""

from __future__ import annotations

import numpy as np

_NONE = np.uint32(0xFFFFFFFF)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_MUL = np.uint64(0x9E3779B97F4A7C15)
_BITS = 18


class MergeTable:
    """Hash table (a, b) -> (rank, merged id), probed for whole arrays."""

    def __init__(self, merges: dict):
        bits = max(_BITS, int(len(merges) * 4 - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, _EMPTY)
        self.rank = np.full(1 << bits, _NONE, np.uint32)
        self.to = np.zeros(1 << bits, np.uint32)
        pairs = np.array(list(merges), np.uint64).reshape(-1, 2)
        keys = (pairs[:, 0] << np.uint64(32)) | pairs[:, 1]
        slots = ((keys * _MUL) >> self.shift).tolist()
        used = set()
        for k, s, (rank, to) in zip(keys.tolist(), slots, merges.values(), strict=True):
            while s in used:
                s = (s + 1) & self.mask
            used.add(s)
            self.keys[s], self.rank[s], self.to[s] = k, rank, to

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = (a.astype(np.uint64) << np.uint64(32)) | b
        slots = ((keys * _MUL) >> self.shift).astype(np.int64)
        rank, to = self.rank[slots].copy(), self.to[slots].copy()
        wrong = np.flatnonzero(self.keys[slots] != keys)
        while len(wrong):
            got = self.keys[slots[wrong]]
            absent = got == _EMPTY
            rank[wrong[absent]] = _NONE
            wrong = wrong[~absent]
            slots[wrong] = (slots[wrong] + 1) & self.mask
            ok = self.keys[slots[wrong]] == keys[wrong]
            rank[wrong[ok]], to[wrong[ok]] = self.rank[slots[wrong[ok]]], self.to[slots[wrong[ok]]]
            wrong = wrong[~ok]
        return rank, to


def merge_all(table: MergeTable, sym: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Final (symbols, fragment numbers) of fragments given by ``seg`` (ascending), in order."""
    done_sym, done_seg = [], []
    rank = np.full(len(sym), _NONE, np.uint32)
    to = np.zeros(len(sym), np.uint32)
    inner = np.flatnonzero(seg[:-1] == seg[1:])
    rank[inner], to[inner] = table.find(sym[inner], sym[inner + 1])
    while len(sym):
        first = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
        low = np.minimum.reduceat(rank, first)
        lens = np.diff(np.append(first, len(sym)))
        live = np.repeat(low != _NONE, lens)
        if not live.all():
            done_sym.append(sym[~live])
            done_seg.append(seg[~live])
            sym, seg, rank, to = sym[live], seg[live], rank[live], to[live]
            lens, low = lens[low != _NONE], low[low != _NONE]
            if not len(sym):
                break
        at = np.flatnonzero(rank == np.repeat(low, lens))
        s = seg[at]
        at = at[np.append(True, s[1:] != s[:-1])]  # the leftmost of each fragment
        sym[at] = to[at]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        sym, seg, rank, to = sym[keep], seg[keep], rank[keep], to[keep]
        at = at - np.arange(len(at))  # one symbol before each of them has gone
        rank[at] = _NONE
        right = at[at + 1 < len(sym)]
        right = right[seg[right] == seg[right + 1]]
        left = at[at > 0]
        left = left[seg[left] == seg[left - 1]] - 1
        again = np.concatenate([left, right])
        rank[again], to[again] = table.find(sym[again], sym[again + 1])
    if not done_sym:
        return sym, seg
    sym, seg = np.concatenate(done_sym), np.concatenate(done_seg)
    order = np.argsort(seg, kind="stable")
    return sym[order], seg[order]
