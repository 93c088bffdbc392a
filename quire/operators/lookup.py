"""Array items looked up in a table of any size, one plan for every size.

The first entries of the table, in order of rank, as many as fit in ``DICT_BYTES``, are a broadcast
dictionary that rows meet where they are read.  Only what it misses leaves a row, once per row and
item, without the row's other values: distinct misses are counted (partial sums), meet the rest of the
table in a join of unique keys, and come back (``skew.join_unique``, so a hot item that the dictionary lacks is no hot
key).  Rows that miss nothing are not shuffled.  With a table inside the dictionary the same plan has no misses, or only unknown items.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.indexing import write_table
from quire.operators.skew import join_unique

#: Bytes of the broadcast dictionary: 16 for each entry and those of its item and value.
DICT_BYTES = 16 << 20
_ENTRY, _BLOCK = 16, 4096


def _size(c: str, kind: T.DataType):
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(c)
    return F.size(c) * 8 if isinstance(kind, T.ArrayType) else F.lit(8)


def dictionary_end(table: DataFrame, item: str, value: str, rank: str, most: int | None = None) -> int:
    """The first rank (dense, from 0) that is not in the dictionary; blocks of ranks go in whole."""
    bound = min(DICT_BYTES // _ENTRY, most if most is not None else DICT_BYTES // _ENTRY)
    cost = _ENTRY + _size(item, table.schema[item].dataType) + _size(value, table.schema[value].dataType)
    block = min(_BLOCK, max(1, bound))
    blocks = table.where(F.col(rank) < bound).groupBy(F.floor(F.col(rank) / block).alias("b")).agg(
        F.sum(cost).alias("bytes")).collect()  # at most DICT_BYTES / 16 / 4096 rows
    total, end = 0, 0
    for r in sorted(blocks, key=lambda r: r["b"]):
        total += r["bytes"]
        if total > DICT_BYTES:
            break
        end = min(bound, (r["b"] + 1) * block)
    return end


class Dictionary(NamedTuple):
    """The broadcast part of a table, made once for many lookups: the first rank that is not in it, [items, values], nothing else is in the table."""
    end: int
    known: Broadcast
    whole: bool


def dictionary(table: DataFrame, item: str, value: str, rank: str, most: int | None = None) -> Dictionary:
    end = dictionary_end(table, item, value, rank, most)
    return Dictionary(end, _broadcast(table, item, value, rank, end), table.where(F.col(rank) >= end).isEmpty())


def _broadcast(table: DataFrame, item: str, value: str, rank: str, end: int) -> Broadcast:
    hot = table.where(F.col(rank) < end).select(F.col(item).alias("item"), F.col(value).alias("value")).toArrow()
    return table.sparkSession.sparkContext.broadcast([hot.column(c).combine_chunks() for c in ("item", "value")])


def lookup(df: DataFrame, col: str, table: DataFrame, item: str, value: str, rank: str, out_col: str,
           default=None, most: int | None = None, fallback=None, made: Dictionary | None = None) -> DataFrame:
    """``df`` with ``out_col``, the ``value`` of every item of the array ``col`` (dropped) in its place.

    ``table`` has unique ``item`` and dense ``rank`` from 0, frequent items first.  Items that are not in it, and null
    items, have ``default``; ``fallback`` (DataFrame of ``item`` -> the same with ``value``) may give distinct unknown items a value
    first.  A null array gives an empty one.  Rows are kept as they are, repeated ones too.  ``most`` bounds
    the dictionary's entries below its byte bound.  ``made``: the ``dictionary`` of the table, if there is one already; if that
    is the whole table, nothing needs to leave a row."""
    keep = [c for c in df.columns if c not in (col, out_col)]
    end = made.end if made else dictionary_end(table, item, value, rank, most)
    known = made.known if made else _broadcast(table, item, value, rank, end)
    item_type, value_type = table.schema[item].dataType, table.schema[value].dataType
    rows = df.select(F.struct(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), F.lit(0).alias("_")).alias("row"),
                     F.coalesce(F.col(col), F.array().cast(T.ArrayType(item_type))).alias("items"),
                     F.monotonically_increasing_id().alias("key"))
    fill = F.lit(default).cast(value_type)
    out = [*(F.col("row")[f"_{i}"].alias(c) for i, c in enumerate(keep)), F.col("values").alias(out_col)]
    filled = F.transform("values", lambda v: F.coalesce(v, fill)).alias("values")
    schema = rows.select("key", "row").schema
    for name, kind in (("values", value_type), ("miss", item_type), ("slots", T.IntegerType())):
        schema = schema.add(name, T.ArrayType(kind))

    def whole(batches):
        items, values = known.value
        for b in batches:
            lists = b.column("items")
            lens = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            where = pc.index_in(lists.flatten(), value_set=items)
            yield pa.RecordBatch.from_arrays([b.column("row"), _lists(values.take(where), lens)], names=["row", "values"])

    if made and made.whole and fallback is None:
        plain = T.StructType([schema["row"], T.StructField("values", T.ArrayType(value_type))])
        return rows.select("row", "items").mapInArrow(whole, plain).select("row", filled).select(*out)

    def run(batches):
        items, values = known.value
        for b in batches:
            if not b.num_rows:
                continue
            lists = b.column("items").combine_chunks() if isinstance(b.column("items"), pa.ChunkedArray) else b.column("items")
            flat, lens = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            where = pc.index_in(flat, value_set=items)
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("row"), _lists(values.take(where), lens), *_misses(flat, where, lens)],
                names=["key", "row", "values", "miss", "slots"])

    rows = write_table(rows.select("key", "row", "items").mapInArrow(run, schema), "looked-up")
    lost = rows.where(F.size("miss") > 0)
    places = lost.select("key", F.posexplode("miss").alias("k", "item"))
    kinds = places.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    rest = table.where(F.col(rank) >= end).select(F.col(item).alias("item"), F.col(value).alias("value"))
    kinds = write_table(kinds.join(rest, "item", "left"), "missed-items")
    if fallback is not None:
        own = fallback(kinds.where(F.col("value").isNull()).select("item")).select("item", F.col("value").alias("own"))
        kinds = write_table(kinds.join(own, "item", "left").withColumn("value", F.coalesce("value", "own")).drop("own"), "missed-items")
    hit = join_unique(places, kinds.select("item", "value", "n"), "item")
    got = hit.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "value"))), lambda x: x["value"]).alias("got"))
    # slot 0: found in the row, slot k: the row's k-th miss; get() counts from 0
    joined = lost.join(got, "key").select("row", F.zip_with("values", "slots", lambda v, s: F.coalesce(
        v, F.get("got", s - 1), fill)).alias("values"))
    sure = rows.where(F.size("miss") == 0).select("row", filled)
    return sure.unionByName(joined).select(*out)


def _lists(flat, lens):
    return pa.ListArray.from_arrays(pa.array([0, *lens.cumsum().tolist()], pa.int32()), flat)


def _misses(flat, where, lens):
    """(distinct misses of each row, for each item 0 or the number of its miss; the latter empty for rows without any)."""
    n = len(lens)
    missed = pc.and_(pc.is_null(where), pc.is_valid(flat)).to_numpy(zero_copy_only=False).astype(bool)
    owner = np.repeat(np.arange(n), lens)
    coded = flat.filter(pa.array(missed)).dictionary_encode()
    size = max(len(coded.dictionary), 1)
    pairs, slot = np.unique(owner[missed] * size + coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), return_inverse=True)
    own, code = np.divmod(pairs, size)
    counts = np.bincount(own, minlength=n)
    miss = _lists(coded.dictionary.take(pa.array(code)), counts)
    slots = np.zeros(len(flat), np.int32)
    slots[missed] = slot - (np.cumsum(counts) - counts)[owner[missed]] + 1
    some = counts > 0
    return miss, _lists(pa.array(slots[some[owner]]), np.where(some, lens, 0))
