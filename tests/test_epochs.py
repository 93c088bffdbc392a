"""Epoch order by a keyed permutation."""

import pytest
from pyspark.sql import functions as F

from quire.operators import batching


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 99, 1000, 4097])
def test_permutation_is_a_bijection(spark, n):
    df = spark.range(n).select(*(batching.permuted(F.col("id"), n, seed, e).alias(f"p{seed}{e}") for seed, e in ((1, 1), (1, 2), (2, 1))))
    cols = list(zip(*df.collect()))
    assert all(sorted(c) == list(range(n)) for c in cols)
    if n > 16:
        assert len({tuple(c) for c in cols}) == 3
        # places do not follow the index
        assert sum(abs(a - b) == 1 for a, b in zip(cols[0], cols[0][1:])) < n / 4


def test_epochs_cover_all_rows_at_any_partitioning(spark):
    rows = [(i * 7 % 101, f"r{i}") for i in range(101)]
    out = []
    for parts in (1, 8):
        df = spark.createDataFrame(rows, "k long, v string").repartition(parts)
        e = batching.epochs(df, ["k"], 2, batch_size=8, seed=5)
        out.append(sorted(map(tuple, e.collect())))
        batches = batching.collect(e, ["k", "v"], ["epoch", "batch_id"]).collect()
        for epoch in (1, 2):
            own = sorted((b.batch_id, len(b.rows)) for b in batches if b.epoch == epoch)
            assert own == [(i, 8) for i in range(12)] + [(12, 5)]
            assert sorted(r.k for b in batches if b.epoch == epoch for r in b.rows) == list(range(101))
    assert out[0] == out[1]
    order = lambda ep: [k for k, _, e, b, p in sorted(out[0], key=lambda t: (t[3], t[4])) if e == ep]
    assert order(1) != order(2)
    assert batching.epochs(spark.createDataFrame([], "k long"), ["k"], 2).collect() == []


def test_padding_needs_an_id(spark):
    from quire.operators import chunking
    with pytest.raises(ValueError):
        chunking.pad(spark.createDataFrame([([1],)], "ids array<int>"), 4, "ids", None)
