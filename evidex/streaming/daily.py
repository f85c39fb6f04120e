"""Structured Streaming forms of the batch steps.

Micro-batches are inserted by key into stored tables, and results are read from these: they do not depend on the order of
the files, on how many come in a batch, or on how late a row is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidex.sources.writes import TableFolder


def read_files_as_stream(spark: SparkSession, folder: str, pattern: str, files_per_batch: int = 64) -> DataFrame:
    """Parquet files below a folder as a stream; the schema is the one of the files already there.

    `pattern` names files, or a table that is itself a folder of part files.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    if len(found) == 1 and found[0].isDirectory():
        folder, pattern = f"{folder}/{pattern}", "*.parquet"
    options = {"pathGlobFilter": pattern, "recursiveFileLookup": "true"}
    schema = spark.read.options(**options).parquet(folder).schema
    return spark.readStream.schema(schema).options(**options, maxFilesPerTrigger=files_per_batch).parquet(folder)


def event_days(events: DataFrame, ts: str, kpi_id: str, event_key: str) -> DataFrame:
    """(event_key, kpi_id, day) of each event: what a daily count has to remember of it."""
    return events.select(
        F.col(event_key).cast("string").alias("event_key"), F.col(kpi_id).alias("kpi_id"), F.to_date(F.col(ts).cast("timestamp")).alias("day")
    )


def daily_counts(days: DataFrame) -> DataFrame:
    """(kpi_id, ts, value) per day from the events that have come so far, the open day included."""
    counted = days.groupBy("kpi_id", F.col("day").alias("ts")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return counted.select("kpi_id", "ts", "value")


def insert_stream(
    stream: DataFrame, tables: TableFolder, name: str, checkpoint: str, step: Callable[[DataFrame], DataFrame] = lambda df: df
) -> None:
    """Run a batch step on every micro-batch and store the result by key; a replayed batch adds nothing."""
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: tables.insert(name, step(batch)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
