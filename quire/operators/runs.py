"""Training-run bookkeeping as tables: history, early stopping, best epoch,
learning-rate schedule, run registry, promotion, resume point, configs.

A history is ``(run, epoch, train_loss, eval_loss)``; every rule is a window
partitioned by run (the epochs of one run are few) or a grouped aggregate.
"""

from __future__ import annotations

import os
import re
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

INF = float("inf")
# The run-name format and its matching pattern, and the learning-rate decay per epoch.
RUN_NAME_FORMAT = "yyyy-MM-dd_HH-mm-ss"
RUN_NAME_PATTERN = r"^\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}$"
LR_DECAY = 0.95
CSV_COLUMNS = ("epoch", "train_loss", "eval_loss", "lr")
#: Run folders that a task of the CSV sink writes, about.
FOLDERS_PER_TASK = 100
#: Characters that Spark escapes in the name of a partition's folder.
_PATH_CHARS = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def run_name(ts: Column, resume: Column | None = None) -> Column:
    """Run name: the resumed run's name, else the start time formatted."""
    name = F.date_format(ts, RUN_NAME_FORMAT)
    return F.coalesce(resume, name) if resume is not None else name


def number_epochs(df: DataFrame, run_col: str, order_col: str, start_epoch: int = 1,
                  out_col: str = "epoch") -> DataFrame:
    """Epoch numbers in ``order_col`` order within each run, starting at ``start_epoch``."""
    w = Window.partitionBy(run_col).orderBy(order_col)
    return df.withColumn(out_col, (F.row_number().over(w) + (start_epoch - 1)).cast("int"))


def with_lr(df: DataFrame, lr: float = 1e-4, gamma: float = LR_DECAY, epoch_col: str = "epoch") -> DataFrame:
    """Learning rate recorded for an epoch: lr * gamma^(epoch - 1)."""
    return df.withColumn("lr", F.lit(lr) * F.pow(F.lit(gamma), F.col(epoch_col) - 1))


def _best_before(run_col: str, epoch_col: str, loss_col: str) -> Column:
    w = (Window.partitionBy(run_col).orderBy(epoch_col)
         .rowsBetween(Window.unboundedPreceding, -1))
    # min() treats NaN as the largest value, so NaN only survives when it is alone
    return F.coalesce(F.nanvl(F.min(loss_col).over(w), F.lit(INF)), F.lit(INF))


def running_best(df: DataFrame, run_col: str = "run", epoch_col: str = "epoch",
                 loss_col: str = "eval_loss") -> DataFrame:
    """``best_before`` (inf at the start) and ``is_best`` (strictly below it: first of equals wins)."""
    bb = _best_before(run_col, epoch_col, loss_col)
    return (df.withColumn("best_before", bb)
              .withColumn("is_best", F.coalesce(F.col(loss_col) < F.col("best_before"), F.lit(False))))


def early_stop(df: DataFrame, patience: int = 3, delta: float = 1e-3, run_col: str = "run",
               epoch_col: str = "epoch", loss_col: str = "eval_loss", truncate: bool = False,
               state: DataFrame | None = None) -> DataFrame:
    """Patience counter per epoch, as windows.

    Sequential rule: v < best - delta -> best = v, counter = 0; else v < best ->
    best = v; else counter + 1; stop when counter >= patience.  Because best is
    always the running minimum, the counter is the number of non-improving
    epochs since the last epoch that improved by more than delta.

    Adds ``counter`` and ``stop``; with ``truncate`` the epochs after the first
    stop are dropped.  ``state`` (run, best, counter; at most a row per run, see ``early_stop_state``) is what an earlier part of the
    run has left: the rule goes on from it, and runs without a row start anew.
    """
    w = Window.partitionBy(run_col).orderBy(epoch_col)
    v = F.col(loss_col)
    best, before = _best_before(run_col, epoch_col, loss_col), F.lit(0)
    if state is not None:
        df = df.join(state.select(F.col("run").alias(run_col), F.col("best").alias("_sb"), F.col("counter").alias("_sc")), run_col, "left")
        best = F.least(best, F.coalesce("_sb", F.lit(INF)))
        before = F.when(F.col("_grp") == 0, F.coalesce("_sc", F.lit(0))).otherwise(0)
    out = df.withColumn("_bb", best)
    out = (out.withColumn("_reset", F.coalesce(v < F.col("_bb") - F.lit(delta), F.lit(False)).cast("int"))
              .withColumn("_miss", (~F.coalesce(v < F.col("_bb"), F.lit(False))).cast("int")))
    out = out.withColumn("_grp", F.sum("_reset").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    wg = (Window.partitionBy(run_col, "_grp").orderBy(epoch_col)
          .rowsBetween(Window.unboundedPreceding, 0))
    out = (out.withColumn("counter", (F.sum("_miss").over(wg) + before).cast("int"))
              .withColumn("stop", F.col("counter") >= patience))
    if truncate:
        first_stop = F.min(F.when(F.col("stop"), F.col(epoch_col))).over(Window.partitionBy(run_col))
        out = (out.withColumn("_fs", first_stop)
                  .where(F.col("_fs").isNull() | (F.col(epoch_col) <= F.col("_fs"))).drop("_fs"))
    return out.drop("_bb", "_reset", "_miss", "_grp", "_sb", "_sc")


def early_stop_state(df: DataFrame, patience: int = 3, delta: float = 1e-3, run_col: str = "run", epoch_col: str = "epoch",
                     loss_col: str = "eval_loss", state: DataFrame | None = None) -> DataFrame:
    """``run, best, counter`` after every epoch of ``df`` (with ``epoch``): what ``early_stop`` needs to go on from there."""
    stop = early_stop(df, patience, delta, run_col, epoch_col, loss_col, state=state)
    w = Window.partitionBy(run_col).orderBy(epoch_col).rowsBetween(Window.unboundedPreceding, 0)
    best = F.coalesce(F.nanvl(F.min(loss_col).over(w), F.lit(INF)), F.lit(INF))
    if state is not None:
        stop = stop.join(state.select(F.col("run").alias(run_col), F.col("best").alias("_sb")), run_col, "left")
        best = F.least(best, F.coalesce("_sb", F.lit(INF)))
    return stop.select(F.col(run_col).alias("run"), F.col(epoch_col).alias("epoch"), best.alias("best"), "counter")


def full_snapshots(history: DataFrame, config: DataFrame, patience: int = 3, delta: float = 1e-3) -> DataFrame:
    """What a run leaves on disk: for the last new best and for the early stop (``kind``) the epoch, the histories up to it, the state
    of the early-stop rule and the run's config.

    ``history``: run, epoch, train_loss, eval_loss, lr.  ``config``: run, config (JSON).  A run's histories are as long as the run;
    runs are independent, and only the kept snapshots carry them."""
    kept = running_best(early_stop(history, patience, delta, truncate=True))
    ends = kept.groupBy("run").agg(F.max(F.when(F.col("is_best"), F.col("epoch"))).alias("best"),
                                   F.min(F.when(F.col("stop"), F.col("epoch"))).alias("earlystop"))
    marks = ends.select("run", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("at"))
                                                   for k in ("best", "earlystop")))).alias("m")).select("run", "m.kind", "m.at").where("at IS NOT NULL")
    upto = history.join(marks, "run").where(F.col("epoch") <= F.col("at"))
    in_order = F.array_sort(F.collect_list(F.struct("epoch", "train_loss", "eval_loss", "lr")))
    rows = upto.groupBy("run", "kind", "at").agg(in_order.alias("h")).withColumnRenamed("at", "epoch")
    state = early_stop_state(history, patience, delta).select("run", "epoch", F.struct("best", "counter").alias("early_stop"))
    return rows.join(state, ["run", "epoch"]).join(config.select("run", "config"), "run", "left").select(
        "run", "kind", "epoch", F.col("h.train_loss").alias("train_loss_history"), F.col("h.eval_loss").alias("eval_loss_history"),
        F.col("h.lr").alias("lr_history"), "early_stop", "config")


def resume(snapshots: DataFrame, later: DataFrame, patience: int = 3, delta: float = 1e-3) -> DataFrame:
    """Counters of the epochs ``later`` (run, epoch, eval_loss) of runs resumed from their 'best' snapshot: the epochs after it, judged
    from the snapshot's state; runs without a snapshot start with epoch 1 and no state."""
    best = snapshots.where("kind = 'best'").select("run", F.col("epoch").alias("_at"), "early_stop.best", "early_stop.counter")
    rows = later.join(best.select("run", "_at"), "run", "left").where(F.col("epoch") > F.coalesce("_at", F.lit(0))).drop("_at")
    return early_stop(rows, patience, delta, state=best)


def best_epoch(df: DataFrame, run_col: str = "run", epoch_col: str = "epoch",
               loss_col: str = "eval_loss") -> DataFrame:
    """First epoch with the minimal finite loss per run; runs with only inf/NaN have none."""
    finite = df.where(~F.isnan(loss_col) & (F.col(loss_col) < F.lit(INF)))
    return finite.groupBy(run_col).agg(
        F.min_by(F.col(epoch_col), F.struct(F.col(loss_col), F.col(epoch_col))).alias("best_epoch"),
        F.min(loss_col).alias("best_loss"))


def runs_from_history(history: DataFrame, model_name: str, root: str = "runs") -> DataFrame:
    """Run registry rows ``(run_time, model_name, epoch, eval_loss, path, kind)``: one 'best' row
    per run with a finite loss, named by the time the run started."""
    start = history.groupBy("run").agg(F.min("first_ts").alias("start_ts"))
    best = best_epoch(history).join(start, "run")
    rt = run_name(F.col("start_ts"))
    return best.select(
        rt.alias("run_time"), F.lit(model_name).alias("model_name"),
        F.col("best_epoch").alias("epoch"), F.col("best_loss").alias("eval_loss"),
        F.concat(F.lit(f"{root}/"), rt, F.lit(f"/{model_name}/best")).alias("path"),
        F.lit("best").alias("kind"))


def list_runs(names: DataFrame, name_col: str = "run_time") -> DataFrame:
    """Run names matching ``YYYY-MM-DD_HH-MM-SS`` exactly, sorted, distinct."""
    return (names.select(F.col(name_col).alias("run_time"))
                 .where(F.col("run_time").rlike(RUN_NAME_PATTERN)).distinct().orderBy("run_time"))


def promote(registry: DataFrame, runs: DataFrame, run_times: DataFrame,
            model_name: str, root: str = "registry") -> DataFrame:
    """Registry after promoting the best checkpoint of each requested run.

    ``registry``: ``(model_name, run_time, epoch, eval_loss, path)``.  For each
    requested ``run_time`` the run's 'best' row is looked up; a request with
    no such row fails the job (as a missing file fails the copy).  When one
    model name is promoted several times, the last request (``seq``) wins; the
    new entry replaces the old one (upsert keyed by model name).
    """
    best = runs.where((F.col("kind") == "best") & (F.col("model_name") == model_name))
    found = run_times.join(best, "run_time", "left")
    checked = found.withColumn(
        "path", F.when(F.col("path").isNull(),
                       F.raise_error(F.concat(F.lit("no best snapshot of run "), F.col("run_time"))))
        .otherwise(F.col("path")))
    latest = checked.groupBy("model_name").agg(
        F.max_by(F.struct("run_time", "epoch", "eval_loss", "path"), "seq").alias("_n"))
    new = latest.select("model_name", "_n.run_time", "_n.epoch", "_n.eval_loss",
                        F.concat(F.lit(f"{root}/"), F.col("model_name")).alias("path"))
    return registry.join(new.select("model_name"), "model_name", "left_anti").unionByName(new)


def resume_point(history: DataFrame, run_col: str = "run", epoch_col: str = "epoch",
                 loss_col: str = "eval_loss") -> DataFrame:
    """Where a resumed run starts: best epoch + 1 (1 when the run has no best)."""
    runs = history.select(run_col).distinct()
    best = best_epoch(history, run_col, epoch_col, loss_col)
    return (runs.join(best, run_col, "left")
                .select(run_col, F.col("best_epoch"),
                        (F.coalesce(F.col("best_epoch"), F.lit(0)) + 1).cast("int").alias("start_epoch")))


def merge_config(base: Column, override: Column) -> Column:
    """Map merge where keys of ``override`` win (dict update); a null override changes nothing."""
    override = F.coalesce(override, F.create_map().cast("map<string,string>"))
    keep = F.map_filter(base, lambda k, v: ~F.array_contains(F.map_keys(override), k))
    return F.map_concat(keep, override)


def resolve_config(stored: Column, arg: Column) -> Column:
    """Config precedence: stored snapshot, else the JSON argument, else an error."""
    parsed = F.from_json(arg, "map<string,string>")
    return F.coalesce(
        F.from_json(stored, "map<string,string>"), parsed,
        F.raise_error(F.lit("config not found in checkpoint and no config argument given")).cast("map<string,string>"))


def write_history(history: DataFrame, path: str, fmt: str = "csv") -> None:
    """History sink: CSV ``epoch,train_loss,eval_loss,lr`` per run folder, or one JSON row per run.

    Folders, not bytes, are what the CSV sink costs: tasks are cut by their number (given as a number, which adaptive execution
    leaves as it is).  In a folder of the file system that all machines mount, tasks write the files themselves: Hadoop's local file
    system starts a process for each file's permissions.  In any other store each task moves its own folders to their place."""
    if fmt == "csv":
        n, root = history.select("run").distinct().count(), _mounted(history.sparkSession, path)
        tasks = 1 + n // FOLDERS_PER_TASK
        if root is not None:  # a folder is a file to open; what a task costs is more
            tasks = min(tasks, max(4 * history.sparkSession.sparkContext.defaultParallelism, 1 + n // (20 * FOLDERS_PER_TASK)))
        rows = history.select("run", *CSV_COLUMNS).repartition(tasks, "run").sortWithinPartitions("run", "epoch")
        sink = (rows if root is None else rows.limit(0)).write.mode("overwrite").partitionBy("run").option("header", True).option(
            "mapreduce.fileoutputcommitter.algorithm.version", "2")
        if root is None:
            sink.csv(path)
            return
        sink.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").csv(path)  # an empty folder, as any writer begins
        folder = F.coalesce(F.nullif(F.col("run").cast("string"), F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__"))
        lines = rows.select(folder.alias("run"), F.to_csv(F.struct(*CSV_COLUMNS)).alias("line"))
        lines.mapInArrow(_run_files(root), "n long").write.format("noop").mode("overwrite").save()
        open(f"{root}/_SUCCESS", "w").close()
    else:
        per = history.groupBy("run").agg(F.array_sort(F.collect_list(
            F.struct("epoch", "train_loss", "eval_loss", "lr"))).alias("_h"))
        (per.select("run", F.col("_h.train_loss").alias("train_loss"),
                    F.col("_h.eval_loss").alias("eval_loss"), F.col("_h.lr").alias("lr"))
            .write.mode("overwrite").json(path))


def read_history(spark, path: str, schema: str) -> DataFrame:
    """The CSV sink read back.  Its folders are listed by tasks of some hundred folders; Spark's own bound is a task each, up to 10,000."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 16 * spark.sparkContext.defaultParallelism)))
    try:
        return spark.read.schema(schema).option("header", True).csv(path)
    finally:
        spark.conf.set(key, before)


def _mounted(spark, path: str) -> str | None:
    """The plain path of a folder of the local (or mounted) file system, None for any other store."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.makeQualified(where).toUri().getPath() if fs.getScheme() == "file" else None


def _run_files(root: str):
    """Task that writes the CSV lines of its runs, a folder and a file each.  A file has its name when it is whole, the same name in
    every attempt of the task."""
    def save(batches):
        task = TaskContext.get()
        now, out, n = None, None, 0

        def done():
            if out is not None:
                out.close()
                os.replace(out.name, f"{os.path.dirname(out.name)}/part-{task.partitionId():05d}.csv")

        for b in batches:
            for run, line in zip(b.column("run").to_pylist(), b.column("line").to_pylist(), strict=True):
                if run != now:
                    done()
                    folder = f"{root}/run={_PATH_CHARS.sub(lambda m: f'%{ord(m[0]):02X}', run)}"
                    os.makedirs(folder, exist_ok=True)
                    now, n = run, n + 1
                    out = open(f"{folder}/_part-{task.taskAttemptId()}", "w", encoding="utf-8", newline="")
                    out.write(",".join(CSV_COLUMNS) + "\n")
                out.write(line + "\n")
        done()
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return save


def config_snapshot(config: Column) -> Column:
    """Config snapshot of a run as a JSON string (K4)."""
    return F.to_json(config)


def log_metrics(metrics: DataFrame, path: str) -> None:
    """Append scalar metric rows ``(run, tag, step, value)`` to the metric log (K5).

    The step is mandatory: rows without one are refused.
    """
    checked = metrics.withColumn("step", F.when(F.col("step").isNull(), F.raise_error(
        F.concat(F.lit("metric without step: "), F.col("tag")))).otherwise(F.col("step")))
    checked.select("run", "tag", "step", "value").write.mode("append").partitionBy("run").parquet(path)


def snapshots(history: DataFrame, patience: int = 3, delta: float = 1e-3, run_col: str = "run",
              epoch_col: str = "epoch", loss_col: str = "eval_loss") -> DataFrame:
    """Snapshot rows a run leaves (K6): ``kind='best'`` at every new best epoch and
    ``kind='earlystop'`` at the first epoch where the patience counter is reached;
    epochs after that stop are not trained, so they leave nothing."""
    h = running_best(early_stop(history, patience, delta, run_col, epoch_col, loss_col, truncate=True),
                     run_col, epoch_col, loss_col)
    best = h.where("is_best").select(run_col, epoch_col, loss_col, F.lit("best").alias("kind"))
    stop = h.where("stop").select(run_col, epoch_col, loss_col, F.lit("earlystop").alias("kind"))
    return best.unionByName(stop)


def zip_histories(*arrays: Column) -> Column:
    """Zip per-epoch arrays position by position; the shortest wins (``arrays_zip`` alone pads with null)."""
    n = F.least(*[F.size(a) for a in arrays])
    return F.slice(F.arrays_zip(*arrays), 1, n)


def publish(registry: DataFrame, root: str) -> int:
    """Publish a registry as the next version below ``root``; returns its number.

    The table is written to a folder of its own, read back and compared (rows and an order-free hash), and only then named by
    one small file of the manifest, which is committed whole or not at all.  A reader (``published``) follows the manifest, so it sees
    the old version until the new one is complete, and a failed write leaves the old one.  One writer at a time."""
    spark = registry.sparkSession
    manifest = _manifest(spark, root)
    version = (manifest.agg(F.max("version")).first()[0] or 0) + 1
    path = f"{root.rstrip('/')}/v{version}-{uuid.uuid4().hex[:8]}"
    # written once; what is compared is what was computed
    seen = Observation()
    cols = sorted(registry.columns)
    digest = F.sum(F.xxhash64(*cols).bitwiseAND(F.lit((1 << 40) - 1)))
    registry.observe(seen, F.count(F.lit(1)).alias("n"), digest.alias("digest")).write.parquet(path)
    back = spark.read.schema(registry.schema).parquet(path).agg(F.count(F.lit(1)).alias("n"), digest.alias("digest")).first()
    if (back["n"], back["digest"]) != (seen.get["n"], seen.get["digest"]):
        raise RuntimeError(f"registry version {version} was not written whole; the published one stays")
    spark.createDataFrame([(version, path, back["n"])], _MANIFEST).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/manifest")
    return version


_MANIFEST = "version int, path string, n_rows long"


def _manifest(spark, root: str) -> DataFrame:
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{root.rstrip('/')}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)  # nothing published yet


def published(spark, root: str, version: int | None = None) -> DataFrame | None:
    """The newest published registry below ``root`` (or ``version``); None if there is none."""
    rows = _manifest(spark, root)
    if version is not None:
        rows = rows.where(F.col("version") == version)
    last = rows.orderBy(F.desc("version")).limit(1).collect()
    return spark.read.parquet(last[0]["path"]) if last else None
