"""Fixed-size batches, reproducible per-epoch shuffle, batch collection, caps."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.indexing import with_global_index, write_table


def shuffle_key(key_cols: list, seed: int = 0, epoch: int = 1) -> Column:
    """Reproducible random order key from the row key, seed and epoch.

    md5 of the rendered key (first 15 hex digits as a non-negative bigint): the
    same order under task retries (unlike ``rand()``), a new order per epoch,
    and expressible in SQL for the oracle.
    """
    parts = []
    for c in key_cols:
        parts += [F.col(c).cast("string"), F.lit(":")]
    parts += [F.lit(str(seed)), F.lit(":"), F.lit(str(epoch))]
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("long")


def shuffle(df: DataFrame, key_cols: list, seed: int = 0, epoch: int = 1,
            order_col: str = "shuffle_key") -> DataFrame:
    """Add the shuffle order key (the actual reordering happens in ``assign``)."""
    return df.withColumn(order_col, shuffle_key(key_cols, seed, epoch))


def assign(df: DataFrame, order_cols: list, batch_size: int = 32) -> DataFrame:
    """Dense index in ``order_cols`` order, then ``batch_id = idx div B``; last batch may be short."""
    if batch_size <= 0:
        raise ValueError("batch size must be positive")
    out = with_global_index(df, order_cols, "row_idx")
    return (out.withColumn("batch_id", F.floor(F.col("row_idx") / batch_size).cast("long"))
               .withColumn("batch_pos", (F.col("row_idx") % batch_size).cast("int")))


def collect(df: DataFrame, cols: list, batch_col: str | list = "batch_id", pos_col: str = "batch_pos",
            out_col: str = "rows") -> DataFrame:
    """One row per batch with its rows in order (at most ``batch_size`` per group)."""
    item = F.struct(F.col(pos_col).alias("_p"), *[F.col(c) for c in cols])
    return df.groupBy(*([batch_col] if isinstance(batch_col, str) else batch_col)).agg(
        F.transform(F.array_sort(F.collect_list(item)),
                    lambda x: F.struct(*[x[c].alias(c) for c in cols])).alias(out_col))


def cap(df: DataFrame, max_batches: int | None, batch_col: str = "batch_id") -> DataFrame:
    """Keep the first ``max_batches`` batches; None or 0 keeps all."""
    if not max_batches:
        return df
    return df.where(F.col(batch_col) < max_batches)


def batch_sizes(df: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    return df.groupBy(batch_col).agg(F.count(F.lit(1)).alias("n_rows"))


#: Rounds of the permutation, and steps after which a walk that has not come back into range is an error
#: (it leaves the range with a chance of about 1 / sqrt(rows) a step).
ROUNDS, WALK = 4, 64


def permuted(index: Column, n: int, seed: int = 0, epoch: Column | int = 1) -> Column:
    """The place of row ``index`` (0 .. n - 1) in an epoch: a keyed permutation, so an epoch needs no sort and no shuffle.

    A Feistel network over pairs (x % a, x div a) with a * b >= n: each round adds a hash of one half to the other, modulo its
    size, which is a bijection; places from n on are walked on until they fall below n."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))
    epoch = F.lit(epoch) if isinstance(epoch, int) else epoch
    key = F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"))

    def mixed(k, half):
        text = F.concat(key, k.cast("string"), F.lit(":"), half.cast("string"))
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")

    def step(s, k):
        even = k % 2 == 0
        return F.struct(F.when(even, (s["l"] + mixed(k, s["r"])) % a).otherwise(s["l"]).alias("l"),
                        F.when(even, s["r"]).otherwise((s["r"] + mixed(k, s["l"])) % b).alias("r"))

    def once(x):
        start = F.struct((x % a).cast("long").alias("l"), F.floor(x / a).cast("long").alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["r"] * a + s["l"])

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), once(index.cast("long")), lambda x, _: F.when(x < n, x).otherwise(once(x)))
    return F.when(F.assert_true(walked < n).isNull(), walked)


def epochs(df: DataFrame, key_cols: list, epochs: int, batch_size: int = 32, seed: int = 0) -> DataFrame:
    """Every row once per epoch (1 ..) with ``epoch``, ``batch_id`` and ``batch_pos``, in an order of its own in each.

    The dense index over ``key_cols`` (a total order) is made once and written; epochs are replayed from it without a sort."""
    if batch_size <= 0:
        raise ValueError("batch size must be positive")
    rows = write_table(with_global_index(df, key_cols, "row_idx"), "indexed-rows")
    n = rows.count()
    place = permuted(F.col("row_idx"), n, seed, F.col("epoch"))
    return rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(int(epochs))))).withColumn("_place", place).select(
        *df.columns, "epoch", F.floor(F.col("_place") / batch_size).cast("long").alias("batch_id"),
        (F.col("_place") % batch_size).cast("int").alias("batch_pos"))
