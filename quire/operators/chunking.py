"""Fixed-length windows, padding, masks and the decoder shift.

Everything is a per-row expression or a generator (``explode``): no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import arrays as A
from quire.operators.tokenize import PAD_ID


def chunk(df: DataFrame, L: int = 256, ids_col: str = "ids", mask: bool = True,
          keep_ids: bool = False) -> DataFrame:
    """Non-overlapping windows of exactly ``L`` ids, stride ``L``, short tail dropped.

    Adds ``chunk_idx`` (0-based), ``start`` (offset of the first id) and
    ``input_ids`` (+ an all-ones ``attention_mask``).  Rows with fewer than
    ``L`` ids give no chunk.
    """
    if L <= 0:
        raise ValueError("chunk length must be positive")
    n = F.size(ids_col)
    idx = F.when(n >= L, F.sequence(F.lit(0), F.floor(n / L).cast("int") - 1)).otherwise(
        F.array().cast("array<int>"))
    out = df.withColumn("chunk_idx", F.explode(idx))
    out = (out.withColumn("start", F.col("chunk_idx") * L)
              .withColumn("input_ids", F.slice(ids_col, F.col("start") + 1, L)))
    if mask:
        out = out.withColumn("attention_mask", A.ones_mask("input_ids"))
    if not keep_ids:
        out = out.drop(ids_col)
    return out


def truncate(df: DataFrame, n: int, ids_col: str = "ids") -> DataFrame:
    return df.withColumn(ids_col, A.truncate(ids_col, n))


def article_chunks(df: DataFrame, L: int = 256, ids_col: str = "ids", max_tokens: int | None = None) -> DataFrame:
    """Article rule: whole articles (or their first ``max_tokens`` ids) in chunks with all-ones masks."""
    return chunk(truncate(df, max_tokens, ids_col) if max_tokens else df, L, ids_col)


def pad(df: DataFrame, L: int = 64, ids_col: str = "ids", pad_id: int = PAD_ID) -> DataFrame:
    """Truncate/pad right to ``L`` (``input_ids``) and add the real-token mask; a tokenizer without a pad id is refused."""
    if pad_id is None:
        raise ValueError("padding needs a pad id; use the end-of-text id where the tokenizer has none")
    out = (df.withColumn("attention_mask", A.real_mask(ids_col, L))
             .withColumn("input_ids", A.pad(ids_col, L, pad_id)))
    return out.drop(ids_col) if ids_col != "input_ids" else out


def shift(df: DataFrame, ids_col: str = "input_ids", mask_col: str = "attention_mask") -> DataFrame:
    """Decoder pair: inputs and mask lose the last position, labels lose the first."""
    return (df.withColumn("labels", A.shift_labels(ids_col))
              .withColumn("dec_input_ids", A.shift_inputs(ids_col))
              .withColumn("dec_attention_mask", A.shift_inputs(mask_col)))
