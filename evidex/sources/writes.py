"""Keyed writes: insert-if-absent, upsert, purge and counts, as plans and as stored parquet tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidex.operators.chunks import pending
from evidex.operators.groups import topk_per_group
from evidex.session import Intermediate, stored
from evidex.sources.tables import REWRITTEN, TABLES

# Fixed value (default the results depend on).
CACHE_TTL_MIN = 60

# Repeated keys of one insert that are sent to all tasks; more of them meet their rows in a shuffle.
BROADCAST_KEYS = 100_000


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; among several the choice depends only on their contents."""
    rest = [c for c in df.columns if c not in keys]
    order = [F.xxhash64(*rest)] if rest else [F.lit(1)]
    return topk_per_group(df, list(keys), order, 1, "_n").drop("_n")


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows, one per key, whose key the target does not have. A second run yields nothing."""
    return one_per_key(pending(source, target, *keys), keys).select(*source.columns)


def without_repeats(rows: DataFrame, keys: Sequence[str], broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Stored rows, one per key. Repeated keys are found on the keys alone: rows with texts and vectors are only dealt
    out and sorted where a key really repeats."""
    again = stored(rows.groupBy(*keys).count().filter("count > 1").drop("count"), "repeated")
    repeated = again.count()
    if repeated == 0:
        return rows
    if repeated <= broadcast_keys:
        again = F.broadcast(again)
    same = reduce(lambda x, y: x & y, [rows[k].eqNullSafe(again[k]) for k in keys])
    once = rows.join(again, same, "left_anti")
    return once.unionByName(one_per_key(rows.join(again, same, "left_semi"), keys).select(*rows.columns))


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with the missing source rows added; rows it has stay as they are."""
    return target.unionByName(new_rows(target, source, keys), allowMissingColumns=True)


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Source rows replace target rows of the same key or are added; `keep` names columns an update must not change."""
    fresh = one_per_key(source, keys)
    if keep:
        old = target.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in keep])
        fresh = fresh.join(old, list(keys), "left")
        for c in keep:
            new = F.col(c) if c in fresh.columns else F.lit(None).cast(target.schema[c].dataType)
            fresh = fresh.withColumn(c, F.coalesce(f"_old_{c}", new))
        fresh = fresh.drop(*[f"_old_{c}" for c in keep])
    untouched = target.join(source.select(*keys).distinct(), list(keys), "left_anti")
    return untouched.unionByName(fresh, allowMissingColumns=True).select(*target.columns)


def purge_expired(df: DataFrame, ts_col: str, now: Column, ttl_min: int = CACHE_TTL_MIN) -> DataFrame:
    """Rows not older than `ttl_min` completed minutes at `now`; rows without a time stay.

    60 min 59 s are 60 completed minutes, so a row goes when it is a whole minute more than `ttl_min` old. The
    border is compared with the plain column and can be checked against the files' statistics.
    """
    border = now.cast(df.schema[ts_col].dataType) - F.make_dt_interval(mins=F.lit(ttl_min + 1))
    return df.filter(F.col(ts_col).isNull() | (F.col(ts_col) > border))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n) with one row per table."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionAll, counts)


class TableFolder:
    """The evidence tables as parquet below one shared folder.

    Append-only tables grow by new files. Tables in REWRITTEN are stored as complete versions `v=N`; a version
    counts once Spark has committed it, so a failed job leaves the last one in force. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, now: Column | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.now = now if now is not None else F.current_timestamp()

    def _schema(self, name: str) -> str:
        return f"{TABLES[name].columns}, created_ts timestamp"

    def _fields(self, name: str) -> list[T.StructField]:
        return T.StructType.fromDDL(self._schema(name)).fields

    def _empty(self, name: str) -> DataFrame:
        """No rows, and the planner knows it: a join with them moves no row of the other side."""
        return self.spark.range(1).filter(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self._fields(name)])

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _committed(self, path: str) -> bool:
        p = self._path(f"{path}/_SUCCESS")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _versions(self, name: str) -> list[int]:
        p = self._path(f"{self.root}/{name}")
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        found = [int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit()]
        return sorted(v for v in found if self._committed(f"{self.root}/{name}/v={v}"))

    def read(self, name: str) -> DataFrame:
        """The table as last committed; an empty one if nothing was written yet."""
        if name in REWRITTEN:
            versions = self._versions(name)
            path = f"{self.root}/{name}/v={versions[-1]}" if versions else None
        else:
            path = f"{self.root}/{name}" if self._committed(f"{self.root}/{name}") else None
        if path is None:
            return self._empty(name)
        columns = [f.name for f in self._fields(name)]
        extra = ", created_day date" if TABLES[name].by_day else ""
        return self.spark.read.schema(self._schema(name) + extra).parquet(path).select(*columns)

    def _shaped(self, df: DataFrame, name: str) -> DataFrame:
        if "created_ts" not in df.columns:
            df = df.withColumn("created_ts", self.now)
        return df.select(*[F.col(f.name).cast(f.dataType) for f in self._fields(name)])

    def _rewrite(self, name: str, df: DataFrame) -> None:
        """Write the next version; the last one stays for readers that began with it, older ones go."""
        versions = self._versions(name)
        df.write.parquet(f"{self.root}/{name}/v={(versions[-1] if versions else 0) + 1}")
        for old in versions[:-1]:
            p = self._path(f"{self.root}/{name}/v={old}")
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def insert(self, name: str, source: DataFrame) -> None:
        """Add the rows whose key is not stored yet."""
        keys, old = TABLES[name].keys, self.read(name)
        if name in REWRITTEN:
            self._rewrite(name, insert_if_absent(old, self._shaped(source, name), keys))
            return
        with Intermediate(self.spark) as steps:
            # Stored as they come, so that the source (a model, perhaps) runs once.
            rows = steps.stored(pending(self._shaped(source, name), old.select(*keys), *keys), "insert")
            once = without_repeats(rows, keys)
            if TABLES[name].by_day:
                once = once.withColumn("created_day", F.to_date("created_ts"))
                once.write.mode("append").partitionBy("created_day").parquet(f"{self.root}/{name}")
            else:
                once.write.mode("append").parquet(f"{self.root}/{name}")

    def upsert(self, name: str, source: DataFrame) -> None:
        """Replace rows of the same key and add the others; an updated row keeps its first creation time."""
        if name not in REWRITTEN:
            raise ValueError(f"{name} is append-only")
        merged = upsert(self.read(name), self._shaped(source, name), TABLES[name].keys, keep=["created_ts"])
        self._rewrite(name, merged)

    def replace(self, name: str, source: DataFrame, groups: Sequence[str]) -> None:
        """Replace all rows of the groups that `source` has, and keep the others."""
        if name not in REWRITTEN:
            raise ValueError(f"{name} is append-only")
        # Used twice: once for its groups, once for its rows.
        fresh = stored(self._shaped(source, name), "replace")
        others = self.read(name).join(fresh.select(*groups).distinct(), list(groups), "left_anti")
        self._rewrite(name, others.unionByName(one_per_key(fresh, TABLES[name].keys)))

    def purge(self, name: str, ttl_min: int = CACHE_TTL_MIN) -> None:
        """Drop expired rows of a rewritten table; without any, nothing is written."""
        if name not in REWRITTEN:
            raise ValueError(f"{name} is append-only")
        old = self.read(name)
        kept = purge_expired(old, "created_ts", self.now, ttl_min)
        if old.count() != kept.count():
            self._rewrite(name, kept)

    def write_index(self, name: str, cells: DataFrame, centers: Sequence[Sequence[float]]) -> None:
        """Store rows by cell and the centroids as the next version of an index; the centroids commit it."""
        from evidex.operators.ivf import write_cells

        versions = self._versions(f"index_{name}")
        path = f"{self.root}/index_{name}/v={(versions[-1] if versions else 0) + 1}"
        write_cells(cells, f"{path}/cells")
        rows = [(i, [float(x) for x in c]) for i, c in enumerate(centers)]
        self.spark.createDataFrame(rows, "cell int, vector array<double>").coalesce(1).write.mode("append").parquet(f"{path}/centers")
        self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration()).create(self._path(f"{path}/_SUCCESS")).close()

    def add_to_index(self, name: str, cells: DataFrame) -> None:
        """Add rows to the cells of the index in force."""
        cells.write.mode("append").partitionBy("cell").parquet(f"{self._index_path(name)}/cells")

    def _index_path(self, name: str) -> str | None:
        versions = self._versions(f"index_{name}")
        return f"{self.root}/index_{name}/v={versions[-1]}" if versions else None

    def read_index(self, name: str) -> tuple[DataFrame, list[list[float]]] | None:
        """(rows with their cell, centroids by cell) of the index in force; None if there is none."""
        path = self._index_path(name)
        if path is None:
            return None
        centers = self.spark.read.parquet(f"{path}/centers").orderBy("cell").collect()
        return self.spark.read.parquet(f"{path}/cells"), [r.vector for r in centers]

    def counts(self) -> DataFrame:
        return table_counts({name: self.read(name) for name in TABLES})
