"""Per-token loss, batch / epoch losses, evaluation and perplexity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.tokenize import PAD_ID

INF = float("inf")


def token_nll(logits: Column | str, label: Column | str) -> Column:
    """Cross-entropy of one position: log-sum-exp of the logits minus the label's logit.

    Computed in the row with array functions (stable: the max is subtracted
    before ``exp``); ``label`` is a 0-based token id.
    """
    from quire.operators.sampling import let
    z = F.transform(F.col(logits) if isinstance(logits, str) else logits, lambda x: x.cast("double"))
    lab = F.col(label) if isinstance(label, str) else label
    return let(z, lambda zz: let(F.array_max(zz), lambda m:
               F.log(F.aggregate(zz, F.lit(0.0), lambda a, x: a + F.exp(x - m))) + m
               - F.element_at(zz, lab + 1)))


def with_token_nll(df: DataFrame, logits_col: str, label_col: str, out_col: str = "nll") -> DataFrame:
    return df.withColumn(out_col, token_nll(logits_col, label_col))


def batch_loss(df: DataFrame, batch_cols: list, nll_col: str = "nll", label_col: str = "label",
               pad_id: int = PAD_ID, out_col: str = "loss") -> DataFrame:
    """Mean loss per batch over labels that are not the pad id (null if none).

    NaN losses are treated as failed positions: left out of the mean and counted.
    """
    valid = (F.col(label_col) != pad_id) & ~F.isnan(F.col(nll_col))
    return df.groupBy(*batch_cols).agg(
        F.avg(F.when(valid, F.col(nll_col))).alias(out_col),
        F.count_if(valid).alias("n_tokens"),
        F.count_if(F.isnan(F.col(nll_col))).alias("n_failed"))


def evaluate(batch_losses: DataFrame, order_cols: list, loss_col: str = "loss",
             max_batches: int | None = None) -> DataFrame:
    """Mean of batch means over all batches, or over the first ``max_batches``.

    Batches without a loss are skipped.  No valid batch gives (inf, inf).  The
    first batches are a bounded top-k (``orderBy().limit``), not a sort of all.
    """
    first = batch_losses.orderBy(*order_cols).limit(int(max_batches)) if max_batches else batch_losses
    return first.agg(
        F.coalesce(F.avg(loss_col), F.lit(INF)).alias("eval_loss"),
        F.count(loss_col).alias("n_batches")).withColumn("perplexity", F.exp("eval_loss"))


def epoch_loss(batch_losses: DataFrame, epoch_cols: list, loss_col: str = "loss") -> DataFrame:
    """Training loss of an epoch = mean of its batch losses (null when none)."""
    return batch_losses.groupBy(*epoch_cols).agg(F.avg(loss_col).alias("train_loss"),
                                                 F.count(loss_col).alias("n_batches"))


def running_loss(batch_losses: DataFrame, epoch_cols: list, step_col: str,
                 loss_col: str = "loss", out_col: str = "running_loss") -> DataFrame:
    """Running mean of batch losses inside an epoch, in step order."""
    w = (Window.partitionBy(*epoch_cols).orderBy(step_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return batch_losses.withColumn(out_col, F.avg(loss_col).over(w))


def perplexity(loss: Column | str) -> Column:
    return F.exp(F.col(loss) if isinstance(loss, str) else loss)
