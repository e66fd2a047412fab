"""Session construction and the shared folder used for checkpoints and handed-over tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
BATCH_BYTES = 4 << 20  # of one Arrow batch between Spark and Python
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def session(app: str = "tidemark", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every operator here assumes."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    A machine-local folder is only made up for a local master; on a cluster an
    unset folder is an error, since executors could not read each other's files.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(CHECKPOINT_DIR, root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_root(spark), f"{name}-{uuid.uuid4().hex}")


def filesystem(path: str):
    """The Arrow file system of a path below the shared folder, and the path as that names it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def via_table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as a parquet table in the shared folder and read it back."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Keep batches small on both sides of the Python workers, however wide their rows; a smaller limit stays."""
    limit = str(spark.conf.get(BATCH_SETTING, "64m")).lower().rstrip("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(limit[-1], 1)
    size = int(limit.rstrip("kmg")) * scale
    if size <= 0 or size > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def spread(df: DataFrame) -> DataFrame:
    """Deal rows to all cores where the input comes in fewer splits than there are cores.

    Meant for small inputs before work that is heavy per row. A large input has more
    splits than that already and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether `path` exists on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
