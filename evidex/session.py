"""Session helpers shared by jobs, tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "8", memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("evidex")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the time zone, so that days and minutes do not depend on where the driver runs."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# Bytes of one Arrow batch that Spark hands to a Python worker.
ARROW_BATCH_BYTES = 4 * 1024 * 1024


def small_arrow_batches(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches by their bytes: by rows alone, ten thousand wide vectors or long texts make one batch.

    A limit that the session already has stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(ARROW_BATCH_BYTES))
    return spark


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared checkpoint directory.

    Without that setting only a session on one machine has a folder that all tasks share; a cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="evidex-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def estimated_splits(df: DataFrame) -> float:
    """Full input splits of a plan by its own size estimate; nothing is run."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    split = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return int(str(size)) / split


def fill_cores(df: DataFrame, *keys: str) -> DataFrame:
    """Spread an input that is too small to give every core a split.

    An input with at least one full split per core keeps the scan's own partitioning, so large tables are
    never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if estimated_splits(df) >= cores else df.repartition(cores, *keys)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back, so that it is computed once."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Intermediate:
    """Tables that are stored for the length of a `with` block; at its end their folders are removed.

    What is made of them must be written by then.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, []

    def __enter__(self) -> Intermediate:
        return self

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        path = shared_folder(self.spark, label)
        self.folders.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *error) -> None:
        for path in self.folders:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
