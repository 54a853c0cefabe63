"""Session helpers: a local session for tests/bench and a checkpoint directory.

The library never picks a machine-local folder on a cluster: it uses the shared
directory named by ``spark.checkpoint.dir`` (or one already set on the context).
Only a local-mode session without that setting gets a fresh temporary folder.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "popcenter") -> SparkSession:
    """A local session configured like the tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only where none is configured.

    Order: a directory already set on the SparkContext, then ``spark.checkpoint.dir``
    from the session conf. Without either, a local-mode session (tests) gets a fresh
    temporary folder, removed at exit; a cluster session raises, because a machine-local folder would
    not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if re.fullmatch(r"local(\[[^\]]*\])?", sc.master):  # one process: tests and the bench
        folder = tempfile.mkdtemp(prefix="popcenter-ckpt-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set: point it at a shared folder (HDFS/S3/ABFS) "
        "so iterative jobs can cut lineage with reliable checkpoints"
    )


#: With it, Spark deletes the shuffle files of an SQL execution when that ends.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint(df):
    """Eager reliable checkpoint in the session's shared checkpoint directory.

    The shuffle files that led to it are dropped at once: nothing reads them again, and a job of
    several checkpointed steps would otherwise hold them all until the driver collects garbage. The
    setting is the session's while the checkpoint is written: queries of other threads that end in that time drop
    theirs too, so run those in a session of their own (``spark.newSession()``).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4()}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class BucketedTable:
    """A frame written once below the checkpoint directory, bucketed by ``key``: two such tables of the same
    number of buckets are joined or cogrouped by the key without an exchange. ``drop`` deletes the files."""

    def __init__(self, df: DataFrame, key: str, buckets: int):
        self.spark = df.sparkSession
        self.path, self.name = scratch_folder(self.spark, "table"), f"popcenter_{uuid.uuid4().hex}"
        df.write.bucketBy(buckets, key).option("path", self.path).saveAsTable(self.name)
        self.df = self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove_folder(self.spark, self.path)
