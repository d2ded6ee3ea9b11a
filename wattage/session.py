"""Spark session settings the library relies on.

Everything time related runs with the session time zone pinned to UTC: the
readings are wall-clock hours without a zone (``timestamp_ntz``) and a few
Spark functions (``date_trunc``) hand back a zoned ``timestamp`` that is cast
back; with UTC the round trip is exact.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of the library expects. AQE re-plans joins and shuffle
# partition counts from runtime statistics; skew-join splits hot partitions.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "wattage") -> SparkSession:
    """Session for tests, the bench and local runs (the UI stays off)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's SQL settings to an existing session (idempotent)."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local on a cluster)."""
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/wattage-scratch/{name}-{uuid.uuid4().hex}"


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[str]:
    """A checkpoint folder of the job's own: checkpoints and scratch folders made
    inside go there, and it is removed at the end, also when the job fails. Frames
    that outlive the job must read stored tables."""
    sc = spark.sparkContext
    outer = ensure_checkpoint_dir(spark)
    sc.setCheckpointDir(f"{outer.rstrip('/')}/job")
    inner = sc.getCheckpointDir()
    try:
        yield inner
    finally:
        # The session's folder comes back as it was (setCheckpointDir would make another one).
        getattr(sc._jsc.sc(), "checkpointDir_$eq")(sc._jvm.scala.Option.apply(outer))
        remove_folder(spark, inner)


def remove_folder(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove every scratch folder of this session (frames that read them end here)."""
    remove_folder(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/wattage-scratch")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    The directory is the shared folder named by ``spark.checkpoint.dir``; it is only
    read here. Only a session whose executors are threads of the driver (master
    ``local`` or ``local[...]``, as in tests) may go without that setting and gets a
    private temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="wattage-ckpt-"))
    return sc.getCheckpointDir()
