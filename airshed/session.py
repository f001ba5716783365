"""Session construction and the shared scratch / checkpoint location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale.  Static (estimate-based) broadcast is
# switched off: a side is broadcast either behind an explicit row-count check
# (operators.joins.bounded_broadcast) or by AQE from the *measured* size of a
# materialised shuffle stage, never from a guessed plan statistic.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "airshed", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the scale defaults applied.

    On a cluster leave ``master`` unset so spark-submit decides; size
    ``shuffle_partitions`` to roughly input bytes / 128 MB (AQE coalesces
    down from there).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in SCALE_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Jobs that cut lineage or need scratch output write below it.  When the
    setting is missing it is filled in only for local sessions (tests); a
    cluster session must name a shared folder, a machine-local temporary
    directory would vanish with the executor that wrote it.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store)")
    d = tempfile.mkdtemp(prefix="airshed-ckpt-")
    sc.setCheckpointDir(d)
    spark.conf.set("spark.checkpoint.dir", d)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/airshed-scratch/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete this library's scratch tables below the checkpoint root.

    Call at the end of a job, once no DataFrame that reads a materialised
    side is still in use.  Returns whether anything was removed.
    """
    root = f"{checkpoint_root(spark)}/airshed-scratch"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p) and fs.delete(p, True))
