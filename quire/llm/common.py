"""Helpers shared by the operators of this folder: table reads, bounded Arrow
slices, vectorised word hashing and ragged gathers."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from quire.session import checkpoint_dir, ship_package

#: Text bytes handled at once inside a task (one longer text is handled alone).
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch between the JVM and a Python worker, and text bytes whose words are hashed at once.
BATCH_BYTES, HASH_BYTES = 2 << 20, 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder known, package importable in the Python workers, Arrow batches of bounded bytes."""
    checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ship_package(spark)


def text_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = pc.fill_null(col, b"")
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    lo = int(off[0])
    return data[lo:int(off[-1])], off - lo


def give_back() -> None:
    """Free memory that this Python worker still holds goes back to the system: a worker outlives its task, beside others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches, text: str, limit: int = SLICE_BYTES):
    """Cut record batches into slices of at most ``limit`` text bytes (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        _, off = text_buffer(b.column(text))
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
            yield b.slice(i, j - i)
            i = j
    give_back()


def ragged(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of ``flat[starts[i]:starts[i] + lens[i]]``."""
    ends = np.cumsum(lens)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.repeat(starts - (ends - lens), lens) + np.arange(ends[-1])]


def binary_array(flat: np.ndarray, bounds: np.ndarray, kind=None) -> pa.Array:
    """Arrow array of the byte ranges ``flat[bounds[i]:bounds[i + 1]]``, without a copy."""
    bounds = np.ascontiguousarray(bounds, np.int64)
    return pa.Array.from_buffers(kind or pa.large_binary(), len(bounds) - 1,
                                 [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(flat))])


_ODD = np.uint64(0x9E3779B97F4A7C15)
_MUL = np.uint64(0xD6E8FEB86659FD93)
_S32 = np.uint64(32)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> _S32)) * _MUL
    h = (h ^ (h >> _S32)) * _MUL
    return h ^ (h >> _S32)


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_INV = np.uint64(pow(int(_ODD), -1, 1 << 64))
_POW: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse; a worker keeps a table for ``HASH_BYTES`` at most (4 MB)."""
    if n <= len(_POW[0]):
        return _POW[0][:n], _POW[1][:n]
    out = []
    for base in (_ODD, _INV):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    if n <= HASH_BYTES + 1:
        _POW[:] = out
    return out[0], out[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges ``data[starts[i]:ends[i]]`` (prefix sums of a polynomial)."""
    p, inv = powers(len(data) + 1)
    h = np.empty(len(data) + 1, np.uint64)
    h[0] = 0
    np.cumsum(_BYTE[data] * p[:len(data)], out=h[1:])
    return mix((h[ends] - h[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``span_hashes`` of spans in order that do not overlap, a block of ``HASH_BYTES`` (one span at least) at a time."""
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASH_BYTES, "right")))
        out[i:j] = span_hashes(data[starts[i]:ends[j - 1]], starts[i:j] - starts[i], ends[i:j] - starts[i])
        i = j
    return out


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + (((data - np.uint8(65)) < 26).astype(np.uint8) << 5)


def spans(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ``inside`` that never cross a text border: starts, ends, text number."""
    n = len(inside)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    border = np.zeros(n + 1, bool)
    border[off] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | border[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | border[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def sorted_groups(batches, keys: list[str]):
    """Tables of the rows of equal ``keys``, from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    before = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_pylist() for k in keys]
        rows = list(zip(*cols, strict=True))
        cuts = [i for i in range(1, len(rows)) if rows[i] != rows[i - 1]]
        for i, j in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            if held and rows[i] != before:
                yield pa.Table.from_batches(held)
                held = []
            before = rows[i]
            held.append(b.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)
    del held
    give_back()
