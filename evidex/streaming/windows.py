"""Daily counts of a stream with state: a watermark, tumbling windows and a bounded memory of keys.

`take_in` splits each micro-batch at the bound that the batches before it have set (their newest event less the delay) and
appends the rows to an event log by day. `count_windows` is a stateful query over the rows within the bound: it drops
repeated keys and counts days in the state store, forgets both once the watermark has passed, and writes what each
trigger has changed. Rows beyond the bound, which such a query would drop unseen, stay in the log as late; `daily_totals`
adds those whose key was not counted, looking only at the log of their own days.

A trigger's work is that of its own rows. The state holds the keys of one run and of the delay before it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENT = "event_key string, kpi_id string, ts timestamp"
LOG = f"{EVENT}, batch bigint, late boolean, day date"
COUNTS = "kpi_id string, ts date, n bigint, batch bigint"
BOUNDS = "newest timestamp, batch bigint"


def _read(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A folder of batches; an empty table if nothing has been written yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def _bound(spark: SparkSession, folder: str, batch: int, delay: str) -> datetime | None:
    """The newest event of the batches before this one, less the delay; a replayed batch gets the same."""
    earlier = _read(spark, f"{folder}/bounds", BOUNDS).filter(F.col("batch") < batch)
    return earlier.agg((F.max("newest") - F.expr(f"interval {delay}")).alias("b")).first()["b"]


def take_in(stream: DataFrame, folder: str, ts: str, kpi_id: str, event_key: str, delay: str = "1 day") -> StreamingQuery:
    """Log the events that have come as (event_key, kpi_id, ts) by batch, lateness and day.

    Events without a key cannot be recognised again and are left out; those without a time are late. A replayed batch
    logs its rows twice, which counts them once, as rows are told apart by their keys.
    """
    spark = stream.sparkSession

    def log(rows: DataFrame, batch: int) -> None:
        events = rows.select(F.col(event_key).cast("string").alias("event_key"), F.col(kpi_id).cast("string").alias("kpi_id"), F.col(ts).cast("timestamp").alias("ts"))
        events = events.filter("event_key is not null")
        bound = _bound(spark, folder, batch, delay)
        late = F.lit(False) if bound is None else F.col("ts") <= F.lit(bound)
        seen = Observation(f"batch{batch}")
        placed = events.withColumns({"late": F.coalesce(F.col("ts").isNull() | late, F.lit(True)), "day": F.to_date("ts")})
        # Grouped by day before it is written, so that a batch adds few files however many tasks read it.
        placed = placed.observe(seen, F.max("ts").alias("newest")).repartition("late", "day", F.pmod(F.xxhash64("event_key"), F.lit(8)))
        placed.write.mode("append").partitionBy("late", "day").parquet(f"{folder}/log/batch={batch}")
        newest = [(seen.get.get("newest"),)]
        spark.createDataFrame(newest, "newest timestamp").coalesce(1).write.mode("overwrite").parquet(f"{folder}/bounds/batch={batch}")

    return stream.writeStream.foreachBatch(log).option("checkpointLocation", f"{folder}/state/log").trigger(availableNow=True).start()


def count_windows(spark: SparkSession, folder: str, delay: str = "1 day") -> StreamingQuery:
    """Count the logged events that came in time, each key once, in windows of a day; to be run after `take_in`.

    One trigger takes all batches that were logged since the last run, so that its watermark never stands beyond the
    bound by which they were let in.
    """
    logged = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 2**31 - 1).parquet(f"{folder}/log").filter(~F.col("late"))
    once = logged.select("event_key", "kpi_id", "ts").withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_key"])
    counted = once.groupBy("kpi_id", F.window("ts", "1 day")).agg(F.count(F.lit(1)).alias("n"))

    def keep(changed: DataFrame, batch: int) -> None:
        rows = changed.select("kpi_id", F.to_date("window.start").alias("ts"), "n")
        rows.write.mode("overwrite").parquet(f"{folder}/counts/batch={batch}")

    query = counted.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{folder}/state/counts")
    return query.trigger(availableNow=True).start()


def daily_totals(spark: SparkSession, folder: str) -> DataFrame:
    """(kpi_id, ts, value) per day: the newest count of each window and the late events that were never counted."""
    counts = _read(spark, f"{folder}/counts", COUNTS)
    in_time = counts.groupBy("kpi_id", "ts").agg(F.max_by("n", "batch").alias("n"))
    log = _read(spark, f"{folder}/log", LOG)
    late = log.filter("late").select("event_key", "kpi_id", "ts", "day").dropDuplicates(["event_key"])
    # Only the days that have late events are read again; a day with a null is in no other part of the log.
    days = late.select("day").distinct()
    known = log.filter(~F.col("late")).join(F.broadcast(days), "day", "left_semi").select("event_key", "day")
    missed = late.join(known, ["event_key", "day"], "left_anti").groupBy("kpi_id", F.col("day").alias("ts")).agg(F.count(F.lit(1)).alias("n"))
    both = in_time.unionByName(missed).groupBy("kpi_id", "ts").agg(F.sum("n").cast("double").alias("value"))
    return both.select("kpi_id", "ts", "value")


def count_stream(stream: DataFrame, folder: str, ts: str, kpi_id: str, event_key: str, delay: str = "1 day") -> StreamingQuery:
    """Take in what has come and count it; the stateful query, whose progress tells the size of its state."""
    take_in(stream, folder, ts, kpi_id, event_key, delay).awaitTermination()
    query = count_windows(stream.sparkSession, folder, delay)
    query.awaitTermination()
    return query


__all__ = ["count_stream", "count_windows", "daily_totals", "take_in"]
