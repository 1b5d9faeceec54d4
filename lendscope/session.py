"""Session construction and shared-storage helpers.

Everything the jobs need from the session is set here once: UTC time zone
and adaptive execution with skew-join splitting. Tests and the bench build
their session through :func:`get_session`; library functions never create a
session themselves.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "lendscope", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the jobs rely on.

    Shuffle sizing: in local mode a small fixed partition count (default 8)
    keeps per-task overhead low. On a cluster the cluster's own
    ``spark.sql.shuffle.partitions`` is kept unless given explicitly, and AQE
    coalesces shuffle output to ``advisoryPartitionSizeInBytes`` from a large
    initial partition count, so a 100 TB shuffle is split into tasks of a
    bounded size instead of a fixed handful. Without ``master`` (a submitted
    job) only the partition count given here is applied.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = bool(master) and master.startswith("local")
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if local:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
        conf["spark.driver.memory"] = "16g"
    else:
        if shuffle_partitions:
            conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        if master:  # an explicit cluster master; without one the submitter's settings stand
            conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = "20000"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Bytecode of the largest method that the JVM compiles (HotSpot's HugeMethodLimit).
COMPILED_BYTES = 8000


def keep_compiled(spark: SparkSession) -> None:
    """Have Spark run a stage operator by operator if its generated method is
    beyond what the JVM compiles. Fused into one such method, a wide projection
    runs interpreted, several times slower; results are the same."""
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535")) > COMPILED_BYTES:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(COMPILED_BYTES))


def shared_dir(spark: SparkSession, name: str = "") -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    The location comes from ``spark.checkpoint.dir`` (or a checkpoint dir set
    on the context). Only a local-mode session without one gets a private
    temporary folder; on a cluster a missing setting is an error, because a
    machine-local folder is not visible to the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="lendscope-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    path = base.rstrip("/") + "/" + (name or "t") + "-" + uuid.uuid4().hex[:12]
    if path.startswith("file:"):
        os.makedirs(path[len("file:"):], exist_ok=True)
    elif "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote, through Spark's file system layer."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs whose DataFrames are gone: its
    cleaner does so when the driver collects garbage, which may otherwise be
    long after the jobs of a loop have filled the disks."""
    gc.collect()
    spark._jvm.System.gc()


def stored_table(df, name: str):
    """``df`` written to the shared folder and read back: computed once, its
    lineage cut, and a lost executor costs a re-read."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
