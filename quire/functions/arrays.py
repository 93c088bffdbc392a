"""Array expressions on token-id sequences: truncate, pad, masks, shift, preview.

All are built-in higher-order / array functions, so they run inside
whole-stage codegen with no Python worker and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def truncate(ids, n: int) -> Column:
    """Keep the first ``n`` ids (right-side truncation)."""
    return F.slice(_c(ids), 1, n)


def article_limit(L: int) -> int:
    """Tokens kept per article before chunking: min(10*L, 2048)."""
    return min(10 * L, 2048)


def pad(ids, L: int, pad_id: int) -> Column:
    """Right-pad with ``pad_id`` to length ``L`` after truncating to ``L``."""
    c = F.slice(_c(ids), 1, L)
    return F.concat(c, F.array_repeat(F.lit(pad_id), F.greatest(F.lit(L) - F.size(c), F.lit(0))))


def real_mask(ids, L: int) -> Column:
    """1 on real tokens, 0 on padding, for a sequence padded to ``L``."""
    n = F.least(F.size(_c(ids)), F.lit(L))
    return F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(L) - n))


def ones_mask(ids) -> Column:
    """All-ones mask of the same length (article chunks)."""
    return F.array_repeat(F.lit(1), F.size(_c(ids)))


def not_pad_mask(ids, pad_id: int) -> Column:
    """Mask derived from the ids themselves: ``id != pad`` (generation prompts)."""
    return F.transform(_c(ids), lambda x: (x != F.lit(pad_id)).cast("int"))


def shift_inputs(a) -> Column:
    """All but the last position (decoder inputs and their mask)."""
    c = _c(a)
    return F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0)))


def shift_labels(a) -> Column:
    """All but the first position (labels)."""
    c = _c(a)
    return F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))


def preview(ids, n: int = 5) -> Column:
    return F.slice(_c(ids), 1, n)


def ids_text(ids) -> Column:
    """Space-separated rendering of an id array (stable scalar for comparisons/sinks)."""
    return F.array_join(F.transform(_c(ids), lambda x: x.cast("string")), " ")
