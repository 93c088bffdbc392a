"""Joins with a table of unique keys whose busy keys are known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is busy if it has more than 1 / BUSY of all rows; so fewer than BUSY keys are.
BUSY = 10_000


def join_unique(left: DataFrame, right: DataFrame, key: str, n_col: str = "n") -> DataFrame:
    """Inner join of ``left`` with ``right``, whose ``key`` is unique and whose ``n_col`` (dropped) is at least the number of left rows.

    Rows of busy keys meet a broadcast of fewer than ``BUSY`` rows, so no key with a great share of the rows is
    shuffled to one task; all others are joined by shuffle.  ``right`` should be a written table: it is read three times.  Of ``BUSY``
    rows or fewer no key is too busy for a task."""
    total = right.agg(F.sum(n_col)).first()[0] or 0
    if total <= BUSY:
        return left.join(right.drop(n_col), key)
    busy = F.col(n_col) * BUSY > F.lit(total)
    common, rare = right.where(busy).drop(n_col), right.where(~busy).drop(n_col)
    return left.join(F.broadcast(common), key).unionByName(
        left.join(F.broadcast(common.select(key)), key, "left_anti").join(rare, key))
