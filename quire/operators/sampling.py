"""Next-token choice from a row of logits: temperature, softmax, greedy,
top-k, nucleus (top-p) and the random draw.

A row holds the whole logits vector of one step (``array<float|double>``), so
everything is computed inside the row with array higher-order functions:
no explode, no window, no shuffle.  Token ids are the 0-based positions in
the vector; ties are broken by the lowest token id.

Every intermediate array is its own column (a separate projection), so each
is computed once; nesting the expressions instead would copy sub-trees into
every reference.

The draw is an inverse-CDF pick with ``u`` from md5 of the row key, seed and
step: reproducible under task retries and expressible in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ITEM = "struct<neg:double,id:int,logit:double>"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def scale(logits, temperature: float = 1.0) -> Column:
    """Logits divided by the temperature, as doubles."""
    if temperature <= 0:
        raise ValueError("temperature must be positive")
    return F.transform(_c(logits), lambda x: x.cast("double") / F.lit(float(temperature)))


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it in ``body`` (a Column -> Column function).

    Implemented with ``aggregate`` over an empty array: the start value is
    computed once per row and handed to the finish function as a lambda
    variable.  Referring to a per-row scalar from inside a per-element lambda
    through a separate projection instead lets the optimizer inline it and
    re-evaluate it for every element.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda a, x: a, body)


def softmax(z) -> Column:
    """Numerically stable softmax of an array column."""
    return let(F.transform(_c(z), lambda x: x.cast("double")), lambda zz:
               let(F.array_max(zz), lambda m:
                   let(F.transform(zz, lambda x: F.exp(x - m)), lambda e:
                       let(F.aggregate(e, F.lit(0.0), lambda a, x: a + x), lambda s:
                           F.transform(e, lambda x: x / s)))))


def with_softmax(df: DataFrame, z_col: str, out_col: str = "probs") -> DataFrame:
    return df.withColumn(out_col, softmax(z_col))


def greedy(z) -> Column:
    """Arg-max token id (first, i.e. lowest id, among equal maxima)."""
    return let(_c(z), lambda zz: (F.array_position(zz, F.array_max(zz)) - 1).cast("int"))


def ranked(z) -> Column:
    """``array<struct<neg, id, logit>>`` in descending logit order, ties by id."""
    return F.sort_array(F.transform(_c(z), lambda x, i: F.struct(
        (-x.cast("double")).alias("neg"), i.alias("id"), x.cast("double").alias("logit"))))


def with_probs(items: Column) -> Column:
    """Items (``id, logit``) with ``prob`` = softmax over their logits."""
    return let(items, lambda it:
               let(F.aggregate(it, F.lit(float("-inf")), lambda a, x: F.greatest(a, x["logit"])), lambda m:
                   let(F.aggregate(it, F.lit(0.0), lambda a, x: a + F.exp(x["logit"] - m)), lambda s:
                       F.transform(it, lambda x: F.struct(
                           x["id"].alias("id"), x["logit"].alias("logit"),
                           (F.exp(x["logit"] - m) / s).alias("prob"))))))


def top_k(z, k: int = 10) -> Column:
    """The ``k`` largest logits with their renormalised probabilities.

    ``k`` larger than the vector is refused (error), as the reference refuses it.
    """
    if k <= 0:
        raise ValueError("top_k must be positive")
    checked = let(ranked(z), lambda r: F.when(
        F.size(r) < k, F.raise_error(F.lit(f"top_k={k} exceeds the number of logits")).cast(f"array<{_ITEM}>")
    ).otherwise(F.slice(r, 1, k)))
    return with_probs(checked)


def nucleus(z, p: float = 0.9) -> Column:
    """Smallest descending prefix whose mass before the last kept token is <= p.

    Token i (0-based, descending) is kept iff i = 0 or the cumulative
    probability of tokens 0..i-1 is <= p; kept probabilities are renormalised.
    The prefix length is one pass (``aggregate``) over the sorted vector.
    """
    def keep(rp):
        acc = F.aggregate(rp, F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("c")),
                          lambda a, x: F.struct((a["s"] + x["prob"]).alias("s"),
                                                (a["c"] + F.when(a["s"] + x["prob"] <= F.lit(float(p)), 1)
                                                 .otherwise(0)).alias("c")))
        return F.slice(rp, 1, F.least(F.size(rp), acc["c"] + 1))

    return let(keep(with_probs(ranked(z))), lambda kept:
               let(F.aggregate(kept, F.lit(0.0), lambda a, x: a + x["prob"]), lambda t:
                   F.transform(kept, lambda x: F.struct(
                       x["id"].alias("id"), x["logit"].alias("logit"), (x["prob"] / t).alias("prob")))))


def with_top_k(df: DataFrame, z_col: str, k: int = 10, out_col: str = "candidates") -> DataFrame:
    return df.withColumn(out_col, top_k(z_col, k))


def with_nucleus(df: DataFrame, z_col: str, p: float = 0.9, out_col: str = "candidates") -> DataFrame:
    return df.withColumn(out_col, nucleus(z_col, p))


def uniform(key_cols: list, seed: int = 0, step: int | None = None) -> Column:
    """u in [0, 1) from md5(key:seed[:step]) (first 8 hex digits / 2^32)."""
    parts = []
    for c in key_cols:
        parts += [F.col(c).cast("string"), F.lit(":")]
    parts.append(F.lit(str(seed)))
    if step is not None:
        parts += [F.lit(":"), F.lit(str(step))]
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def draw(candidates: Column, u: Column) -> Column:
    """First candidate whose cumulative probability exceeds ``u`` (the last if rounding leaves none)."""
    def pick(c):
        acc = F.aggregate(c, F.struct(F.lit(0.0).alias("s"), F.lit(-1).alias("pick")),
                          lambda a, x: F.struct((a["s"] + x["prob"]).alias("s"),
                                                F.when((a["pick"] < 0) & (a["s"] + x["prob"] > u), x["id"])
                                                .otherwise(a["pick"]).alias("pick")))
        return let(acc["pick"], lambda pk: F.when(pk >= 0, pk).otherwise(F.element_at(c, -1)["id"]))
    return let(candidates, pick).cast("int")


def with_draw(df: DataFrame, cand_col: str, u: Column, out_col: str = "next_token") -> DataFrame:
    return df.withColumn("_dr_u", u).withColumn(out_col, draw(F.col(cand_col), F.col("_dr_u"))).drop("_dr_u")


def sample(df: DataFrame, key_cols: list, logits_col: str = "logits", method: str = "top_k",
           top_k_: int = 10, top_p: float = 0.9, temperature: float = 1.0, seed: int = 0,
           step: int | None = None, out_col: str = "next_token") -> DataFrame:
    """Choose the next token per row.  ``greedy``, ``top_p``; any other name means top-k."""
    out = df.withColumn("_z", scale(logits_col, temperature))
    if method == "greedy":
        return out.withColumn(out_col, greedy("_z")).drop("_z")
    if method == "top_p":
        out = with_nucleus(out, "_z", top_p, "_cand")
    else:
        out = with_top_k(out, "_z", top_k_, "_cand")
    return with_draw(out, "_cand", uniform(key_cols, seed, step), out_col).drop("_z", "_cand")


def explode_candidates(df: DataFrame, key_cols: list, cand_col: str) -> DataFrame:
    """Long form ``key, rank (1-based), token_id, prob`` of a candidate array.

    Ids and probabilities are split into parallel arrays before the explode,
    so no struct field is pruned through the generator (which would make the
    optimizer re-inline the whole candidate computation).
    """
    parts = df.select(*key_cols, F.transform(cand_col, lambda x: x["id"]).alias("_ids"),
                      F.transform(cand_col, lambda x: x["prob"]).alias("_ps"))
    return (parts.select(*key_cols, "_ps", F.posexplode("_ids").alias("_r", "token_id"))
                 .select(*key_cols, (F.col("_r") + 1).cast("int").alias("rank"),
                         F.col("token_id").cast("int").alias("token_id"),
                         F.element_at("_ps", F.col("_r") + 1).alias("prob")))


def budget(prompt_len: Column, max_len: int = 64, config_max_len: Column | None = None) -> Column:
    """New tokens allowed: min(config max_len (default 1024), max_len) - prompt length."""
    cfg = F.coalesce(config_max_len, F.lit(1024)) if config_max_len is not None else F.lit(1024)
    return F.greatest(F.least(cfg, F.lit(max_len)) - prompt_len, F.lit(0))


def append_token(ids: Column, mask: Column, token: Column) -> tuple[Column, Column]:
    return F.concat(ids, F.array(token)), F.concat(mask, F.array(F.lit(1)))


def cut_at_eos(ids, prompt_len: Column | int, limit: Column | int, eos_id: int = 0) -> Column:
    """Prompt + generated ids, cut after the first eos *in the generated part*
    (inclusive) and after at most ``limit`` generated ids."""
    ids = _c(ids)
    pl = prompt_len if isinstance(prompt_len, Column) else F.lit(prompt_len)
    lim = limit if isinstance(limit, Column) else F.lit(limit)
    gen = F.slice(ids, pl + 1, F.greatest(F.size(ids) - pl, F.lit(0)))
    pos = F.array_position(gen, F.lit(eos_id))
    keep = F.when(pos > 0, F.least(pos, lim)).otherwise(F.least(F.size(gen), lim))
    return F.concat(F.slice(ids, 1, pl), F.slice(gen, 1, keep))
