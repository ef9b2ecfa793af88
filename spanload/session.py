"""Session construction and the shared scratch folder.

On a cluster the scratch folder is derived from ``spark.checkpoint.dir``
(a shared file system the cluster names).  Only when that setting is
absent — local tests — do we create our own folder and register it.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

_LOCK = threading.Lock()


def build_session(master: str | None = None, cpus: int | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session configured the way every job in this package expects.

    AQE stays on (partition coalescing and skew-join splitting at runtime),
    the session time zone is UTC so key-time arithmetic matches the SQL
    oracle, and the web UI is off.
    """
    submitted = SparkConf().get("spark.master", None)
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder
    if master or not submitted:  # a submitted job keeps its master, memory and partitions
        builder = (builder.master(master or f"local[{cpus}]")
                   .config("spark.driver.memory", "8g")
                   .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus)))
    elif shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder
        .appName("spanload")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only if unset."""
    with _LOCK:
        sc = spark.sparkContext
        current = sc.getCheckpointDir()
        if current:
            return current
        conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
            "spark.checkpoint.dir", None)
        if conf_dir:
            sc.setCheckpointDir(conf_dir)
            return sc.getCheckpointDir() or conf_dir
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # Unset: local test run.  A private folder is fine here.
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spanload-ckpt-"))
        return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, run-unique folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/spanload-scratch/{name}-{uuid.uuid4().hex[:12]}"


def spread(df):
    """Give CPU-heavy per-row work (JSON parsing) every core on small inputs.

    A small file with one row group is a single input split, so parsing it
    runs on one core.  Only an input that is less than one full split for each
    core, by files and by bytes, is spread, round-robin (not by key: a key
    holding a third of the rows would land in one task; Spark sorts before a
    round-robin repartition, so a retried task gets the same rows).  Large
    files split by themselves, so a large input is never shuffled here.
    """
    try:
        session = df.sparkSession
        target = session.sparkContext.defaultParallelism
        # files and bytes are known without a job; asking the RDD would run shuffles
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
        files = len(df.inputFiles())
    except Exception:  # noqa: BLE001 — no view of the plan (e.g. a remote session): leave as is
        return df
    split = session._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if not files or max(files, size // split) >= target:
        return df
    return df.repartition(target)


def materialize(df):
    """Reliable checkpoint into the shared checkpoint folder (never a local one).

    Cuts the lineage and stops later filters from being pushed into the
    projections that produced ``df``.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df, name: str):
    """Written as parquet under the shared checkpoint folder and read back: later passes read the
    columns that they need, and a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
