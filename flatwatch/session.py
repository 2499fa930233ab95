"""Session helpers: building a session for tests/bench, shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "flatwatch", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session used by tests and bench. Production callers pass their own session to every function."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a shared folder there). Only where it
    is unset and everything runs in one local process is a fresh temporary folder created and registered; on a
    cluster that would be another folder on every machine, so it is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:      # no SparkContext on this client
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="flatwatch-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:
            pass
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name below the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), "flatwatch", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str, created: list | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage (a lost executor never re-runs the upstream stages) and lets a result that is
    consumed twice be computed once. The new folder is appended to ``created`` so the caller can
    ``release`` it when every consumer has run.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    if created is not None:
        created.append(path)
    return spark.read.parquet(path)


def release(spark: SparkSession, paths) -> None:
    """Delete intermediate tables (through the Hadoop file system of each path, so any shared store works)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        jp = jvm.org.apache.hadoop.fs.Path(p)
        jp.getFileSystem(conf).delete(jp, True)


def spread(df: DataFrame, key: str | None = None, min_partitions: int | None = None) -> DataFrame:
    """Re-split a scan that yields fewer partitions than the cluster has cores (e.g. one large file).

    Per-row work (regexes, parsing) then runs on every core. Hash partitioning on ``key`` needs no sort (a
    round-robin split would sort every partition first) and lines up with a later join on that key. A many-file
    input at scale already has enough partitions and passes through without a shuffle.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= target:
            return df
    except Exception:          # no RDD access (e.g. a remote session): leave partitioning to the server
        return df
    return df.repartition(target, key) if key else df.repartition(target)
