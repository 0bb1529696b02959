"""Session helper.

The cluster owns ``spark.checkpoint.dir``; we only fill it in when it is unset
in a local session (tests), and never use a machine-local folder otherwise.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Get or create a session with the settings the operators assume
    (UTC session zone, AQE on, UI off)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir``. Where it is unset, a local session
    (driver and executors in one process) gets a scratch folder that goes when
    the process ends; on a cluster there is no folder to fall back on.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def materialize(df, name: str, compression: str | None = None):
    """Cut the lineage of a reused intermediate: write it as Parquet into the
    shared checkpoint folder and read it back. Later plans are a plain scan
    with real size statistics (so planning stays cheap and broadcast
    decisions are informed), and the data survives executor loss. Large tables
    of numbers may name a denser codec."""
    spark = df.sparkSession
    path = scratch_path(spark, f"materialized/{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").options(**({"compression": compression} if compression else {})).parquet(path)
    return spark.read.parquet(path)


def release(spark: SparkSession) -> None:
    """Delete all that this application wrote into the shared folder. Frames
    that read it must not be used any more."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, ""))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder, of this application, of the shared checkpoint folder."""
    return "/".join(x for x in (checkpoint_dir(spark).rstrip("/"), f"tidemark-{spark.sparkContext.applicationId}", name) if x)
