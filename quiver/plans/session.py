"""Session construction and shared-storage settings."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Broadcast budget for query / reference matrices (bytes).  Anything larger
# is cut into several broadcasts.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(master: str | None = None, app: str = "quiver",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the settings the engine assumes (AQE on, UTC, Arrow)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` (or the SparkContext's checkpoint dir).
    Only a local-mode session without one gets a fresh temporary folder; on
    a cluster a machine-local folder would not survive executor loss, so an
    unset directory is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3) "
                           "before running jobs that cut lineage")
    path = tempfile.mkdtemp(prefix="quiver-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written tables/sinks."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{os.urandom(6).hex()}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the checkpoint folder once and read it from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def planned_bytes(df: DataFrame) -> int | None:
    """Spark's own size estimate of a plan, without running anything (None: it has none)."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    # frames made from driver data or RDDs report the largest long
    return size if size < 1 << 60 else None


def planned_tasks(df: DataFrame) -> int:
    """About how many scan tasks a plan has, from its size estimate."""
    spark = df.sparkSession
    size = planned_bytes(df)
    text = spark.conf.get("spark.sql.files.maxPartitionBytes")
    per_task = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))
    return default_parallelism(spark) if size is None else max(1, -(-size // max(per_task, 1)))


def default_parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.sparkContext.defaultParallelism))


_ATTACHED: set = set()


def attach(spark: SparkSession | None = None) -> None:
    """Ship this package to the Python workers (once per application).

    Arrow functions are pickled by reference to ``quiver`` modules, so the
    workers must be able to import the package wherever the driver was
    started: it is zipped and added with ``SparkContext.addPyFile``.
    """
    if spark is None:
        # the session of this thread, else the process's existing one
        spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _ATTACHED:
        return
    pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="quiver-pkg-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _ATTACHED.add(app)
