"""Tables with one folder per day: a change rewrites the days it touches, an expiry drops whole days.

Spark's dynamic partition overwrite replaces the folders of the days that are written and leaves all others alone. What
is written is stored first, as it is read from the folders it replaces. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evidex.session import stored
from evidex.sources.writes import CACHE_TTL_MIN, one_per_key, purge_expired

# Fixed value (the folder that Spark's writers use for a null day).
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


def _folders(spark: SparkSession, path: str, day: str) -> dict[str, object]:
    """Folder name's value -> folder, for each day that is there: one entry per day, no file is listed."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(p)] if fs.exists(p) else []
    return {f.getName()[len(day) + 1 :]: f for f in found if f.getName().startswith(f"{day}=")}


def read_days(spark: SparkSession, path: str, schema: StructType, day: str) -> DataFrame:
    """The table, or an empty one if nothing was written yet; a filter on the day opens only its folders."""
    if not _folders(spark, path, day):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def write_days(rows: DataFrame, path: str, day: str) -> None:
    """Replace the days that `rows` has by its rows; a second run changes nothing."""
    rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(day).parquet(path)


def upsert_days(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], day: str) -> None:
    """Source rows replace rows of the same key or are added; days without a source row keep their files.

    The day is part of the key, as a row that moved to another day would be found in neither. Null days and keys are
    values like others; of several source rows with a key one is taken, by its contents.
    """
    if day not in keys:
        raise ValueError(f"{day} must be one of the keys")
    # Used three times: for its days, its keys and its rows.
    fresh = stored(one_per_key(source, keys), "days")
    days = fresh.select(F.col(day).alias("_day")).distinct()
    old = read_days(spark, path, source.schema, day)
    old = old.join(days, old[day].eqNullSafe(days["_day"]), "left_semi")
    taken = fresh.select(*[F.col(k).alias(f"_{n}") for n, k in enumerate(keys)])
    same = reduce(lambda x, y: x & y, [old[k].eqNullSafe(taken[f"_{n}"]) for n, k in enumerate(keys)])
    merged = old.join(taken, same, "left_anti").unionByName(fresh)
    write_days(stored(merged, "merged"), path, day)


def purge_days(
    spark: SparkSession, path: str, schema: StructType, day: str, ts_col: str, now: Column, ttl_min: int = CACHE_TTL_MIN
) -> tuple[list[str], list[str]]:
    """Drop rows that are a whole minute more than `ttl_min` old; returns the days dropped and those rewritten.

    `day` is the date of `ts_col`. Days before the border go as folders, unread; only the border's own day is read, and
    rewritten if it has expired rows. Rows without a time (and so without a day) stay.
    """
    # One row.
    limit = spark.range(1).select(F.to_date(now - F.make_dt_interval(mins=F.lit(ttl_min + 1)))).first()[0]
    folders = _folders(spark, path, day)
    gone = [d for d in folders if d != NULL_DAY and date.fromisoformat(d) < limit]
    rewritten = []
    if str(limit) in folders:
        rows = read_days(spark, path, schema, day).filter(F.col(day) == F.lit(limit))
        kept = stored(purge_expired(rows, ts_col, now, ttl_min), "kept")
        left = kept.count()
        if not left:
            gone.append(str(limit))
        elif left < rows.count():
            write_days(kept, path, day)
            rewritten.append(str(limit))
    for d in gone:
        folders[d].getFileSystem(spark._jsc.hadoopConfiguration()).delete(folders[d], True)
    return sorted(gone), rewritten
