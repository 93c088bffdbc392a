"""Resumed runs against uninterrupted ones, registry versions, corpora in partitions, the k-th key."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import runs
from quire.sources import corpus


def _history(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for run in range(12):
        v = 3.0
        for e in range(1, rnd.randint(2, 25)):
            v += rnd.choice([-0.3, -0.0005, 0.0, 0.2])
            rows.append((run, e, v + 1, rnd.choice([v] * 6 + [float("nan"), float("inf")]), 1e-4 * 0.95 ** (e - 1)))
    rows += [(50, 1, 1.0, float("inf"), 1e-4), (50, 2, 1.0, float("nan"), 1e-4)]  # never a best epoch
    return rows, spark.createDataFrame(rows, "run long, epoch int, train_loss double, eval_loss double, lr double")


def _key(rows):
    return sorted((r["run"], r["epoch"], r["counter"], r["stop"]) for r in rows)


@pytest.mark.parametrize("at", [0, 2, 9])
def test_fold_goes_on_from_any_epoch(spark, at):
    _, h = _history(spark, at)
    whole = runs.early_stop(h).collect()
    early = h.where(F.col("epoch") <= at)
    state = runs.early_stop_state(early).groupBy("run").agg(F.max_by(F.struct("best", "counter"), "epoch").alias("s")).select("run", "s.*")
    later = runs.early_stop(h.where(F.col("epoch") > at), state=state)
    assert _key(runs.early_stop(early).collect() + later.collect()) == _key(whole)
    # and a second interruption
    mid = runs.early_stop_state(h.where((F.col("epoch") > at) & (F.col("epoch") <= at + 3)), state=state)
    last = mid.groupBy("run").agg(F.max_by(F.struct("best", "counter"), "epoch").alias("s")).select("run", "s.*")
    last = last.unionByName(state.join(last, "run", "left_anti"))
    third = runs.early_stop(h.where(F.col("epoch") > at + 3), state=last).collect()
    assert _key(third) == [k for k in _key(whole) if k[1] > at + 3]


def test_snapshots_carry_what_a_run_needs(spark):
    rows, h = _history(spark, 4)
    config = spark.createDataFrame([(r, f'{{"run":"{r}"}}') for r in range(12)], "run long, config string")
    snaps = {(r.run, r.kind): r for r in runs.full_snapshots(h, config).collect()}
    plain = {}
    for r in runs.snapshots(h).collect():
        plain[r.run, r.kind] = max(r.epoch, plain.get((r.run, r.kind), 0))
    assert {k: r.epoch for k, r in snaps.items()} == plain
    assert not any(run == 50 and kind == "best" for run, kind in snaps)
    for (run, _), s in snaps.items():
        own = [r for r in rows if r[0] == run and r[1] <= s.epoch]
        assert s.train_loss_history == [r[2] for r in own] and s.lr_history == [r[4] for r in own]
        assert str(s.eval_loss_history) == str([r[3] for r in own])
        assert s.config == (f'{{"run":"{run}"}}' if run < 12 else None)
        if s.kind == "best":
            assert s.early_stop.best == min(r[3] for r in own if r[3] == r[3])
    resumed = runs.resume(runs.full_snapshots(h, config), h).collect()
    at = {run: r.epoch for (run, kind), r in snaps.items() if kind == "best"}
    assert _key(resumed) == [k for k in _key(runs.early_stop(h).collect()) if k[1] > at.get(k[0], 0)]


def test_registry_versions(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "registry")
    assert runs.published(spark, root) is None
    one = spark.createDataFrame([("m", 1), ("n", 2)], "model_name string, epoch int")
    assert runs.publish(one, root) == 1 and runs.publish(one.where("epoch = 2"), root) == 2
    assert [r.model_name for r in runs.published(spark, root).collect()] == ["n"]
    assert runs.published(spark, root, 1).count() == 2 and runs.published(spark, root, 9) is None
    # a failure while the table is computed, and one between table and manifest
    with pytest.raises(Exception):
        runs.publish(one.withColumn("epoch", F.raise_error(F.lit("lost")).cast("int")), root)
    monkeypatch.setattr(runs, "_MANIFEST", "no schema")
    with pytest.raises(Exception):
        runs.publish(one, root)
    monkeypatch.undo()
    assert [r.model_name for r in runs.published(spark, root).collect()] == ["n"]
    assert runs.publish(one.where("false"), root) == 3 and runs.published(spark, root).count() == 0


def test_corpus_in_partitions(spark, tmp_path):
    root = str(tmp_path / "corpora")
    rows = [(i, None if i % 11 == 0 else f"t{i}", f"n{i % 3}", ["en", "de"][i % 2], ["train", "test"][i % 5 == 0]) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, name string, config string, split string")
    corpus.write_corpus(df, root)
    got = corpus.read_corpus(spark, root, "n1", "de", "test")
    want = sorted(r[0] for r in rows if r[1] and r[2:] == ("n1", "de", "test"))
    assert want and sorted(r.doc_id for r in got.collect()) == want
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    parts = plan[plan.index("PartitionFilters"):].split("\n")[0]
    assert all(f"= {x})" in parts for x in ("n1", "de", "test"))
    stream = corpus.read_corpus(spark, root, "n1", "de", "test", stream=True)
    q = (stream.writeStream.format("memory").queryName("corpus_rows").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.doc_id for r in spark.table("corpus_rows").collect()) == want


@pytest.mark.parametrize("steps", [50, 1024])
def test_kth_key(spark, monkeypatch, steps):
    monkeypatch.setattr(corpus, "STEPS", steps)
    rnd = random.Random(steps)
    for values in ([5], [rnd.randint(-50, 50) for _ in range(60)], [-2 ** 63, 2 ** 63 - 1, 0, 7, 7], [rnd.randint(0, 10 ** 15) for _ in range(40)]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "k long").repartition(3)
        for k in {1, len(values) // 2 or 1, len(values)}:
            assert corpus.kth_key(df, "k", k) == sorted(values)[k - 1]
        assert corpus.kth_key(df, "k", len(values) + 1) is None


def test_cap_is_a_range_filter(spark, tmp_path):
    spark.range(0, 3000, 3).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    some = corpus.read_articles(docs, "doc_id", 100)
    assert sorted(r.doc_id for r in some.collect()) == list(range(0, 300, 3))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(doc_id,297)" in plan and "Broadcast" not in plan and "Exchange" not in plan
