import math

import numpy as np
import pytest

from quire.operators import batching, metrics


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 64])
def test_batch_sizes(spark, n):
    df = spark.range(n).withColumnRenamed("id", "row_id")
    b = batching.assign(batching.shuffle(df, ["row_id"], 1, 1), ["shuffle_key", "row_id"], 32)
    sizes = sorted((r.batch_id, r.n_rows) for r in batching.batch_sizes(b).collect())
    full, rest = divmod(n, 32)
    assert [s for _, s in sizes] == [32] * full + ([rest] if rest else [])
    assert sorted(r.row_id for r in b.collect()) == list(range(n))


def test_shuffle_is_reproducible_and_per_epoch(spark):
    df = spark.range(200).withColumnRenamed("id", "row_id")
    def order(seed, epoch, parts):
        d = batching.shuffle(df.repartition(parts), ["row_id"], seed, epoch)
        return [r.row_id for r in batching.assign(d, ["shuffle_key", "row_id"], 32).orderBy("row_idx").collect()]
    assert order(1, 1, 1) == order(1, 1, 8)
    assert order(1, 1, 3) != order(1, 2, 3)
    assert sorted(order(1, 2, 3)) == list(range(200))


def test_collect_keeps_order(spark):
    df = spark.range(70).withColumnRenamed("id", "row_id")
    b = batching.assign(df, ["row_id"], 32)
    got = {r.batch_id: [x.row_id for x in r.rows] for r in batching.collect(b, ["row_id"]).collect()}
    assert got == {0: list(range(32)), 1: list(range(32, 64)), 2: list(range(64, 70))}
    assert batching.cap(b, 2).select("batch_id").distinct().count() == 2


def test_token_nll_matches_numpy(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=16).tolist(), int(rng.integers(16))) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, z array<double>, label int")
    got = {r.id: r.nll for r in metrics.with_token_nll(df, "z", "label").collect()}
    for i, z, lab in rows:
        z = np.array(z)
        exp = np.log(np.exp(z - z.max()).sum()) + z.max() - z[lab]
        assert math.isclose(got[i], exp, rel_tol=1e-12)


def test_batch_loss_ignores_pad_and_nan(spark):
    rows = [(0, 5, 1.0), (0, 0, 9.0), (0, 6, 3.0), (1, 0, 4.0), (2, 7, float("nan")), (2, 8, 2.0)]
    df = spark.createDataFrame(rows, "b int, label int, nll double")
    got = {r.b: (r.loss, r.n_failed) for r in metrics.batch_loss(df, ["b"]).collect()}
    assert got[0] == (2.0, 0) and got[1][0] is None and got[2] == (2.0, 1)


def test_evaluate_mean_of_means_and_empty(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "b int, loss double")
    e = metrics.evaluate(df, ["b"], "loss").first()
    assert e.eval_loss == 4.5 and e.n_batches == 10
    e = metrics.evaluate(df, ["b"], "loss", 5).first()
    assert e.eval_loss == 2.0 and e.n_batches == 5 and math.isclose(e.perplexity, math.exp(2.0))
    empty = spark.createDataFrame([], "b int, loss double")
    e = metrics.evaluate(empty, ["b"], "loss", 5).first()
    assert math.isinf(e.eval_loss) and math.isinf(e.perplexity)


def test_running_loss(spark):
    df = spark.createDataFrame([(1, s, float(s)) for s in range(4)], "ep int, step int, loss double")
    got = [r.running_loss for r in metrics.running_loss(df, ["ep"], "step").orderBy("step").collect()]
    assert got == [0.0, 0.5, 1.0, 1.5]
