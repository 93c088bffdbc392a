"""Session construction and the shared checkpoint folder.

On a cluster the session is created by the platform and ``spark.checkpoint.dir``
names a shared folder; we only read it.  A local folder is chosen only when the
master is local and nothing is configured (tests, benchmarks).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


#: Bytes of an Arrow batch between the JVM and a Python worker.  What a worker holds is a small multiple of it, whatever the input's
#: size; Spark's own bound (64 MB, or 10,000 rows) is that of a worker that is alone on its machine.
ARROW_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``ARROW_BYTES`` (one row at least)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def build_session(master: str | None = None, app: str = "quire",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("QUIRE_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("QUIRE_SHUFFLE_PARTITIONS", "8"))
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.default.parallelism", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("QUIRE_DRIVER_MEMORY", "16g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    bound_batches(spark)
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    Order: the context's folder, then ``spark.checkpoint.dir``; a fresh local
    folder only on a local master (a cluster must name a shared one).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="quire-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quire`` importable in Python workers (zip + ``addPyFile``), once per context."""
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="quire-pkg-")) / "quire.zip"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for f in root.rglob("*.py"):
            z.write(f, f.relative_to(root.parent).as_posix())
    sc.addPyFile(str(out))
    _SHIPPED.add(key)
