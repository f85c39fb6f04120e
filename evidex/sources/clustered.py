"""Tables clustered and sorted by their key: joins and inserts by that key move no stored row.

Spark hashes a key to the same bucket in every table of as many buckets, so what is pending, what is new and what
belongs together is found bucket by bucket. Keys should be ids: a key on a large share of the rows is one bucket's load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from evidex.session import stored
from evidex.sources.writes import new_rows


def write_clustered(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Append to the clustered table below `path`, making it if needed; the rows as stored.

    Rows are dealt to as many tasks as buckets in the way that buckets are, so each task adds one file to its bucket.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.format("parquet").option("path", path).mode("append").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)


def open_clustered(spark: SparkSession, table: str, path: str, schema: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Name a clustered table of an earlier session, whose catalog is gone, without reading it."""
    by = ", ".join(f"`{k}`" for k in keys)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"create table if not exists {table} ({schema}) using parquet clustered by ({by}) sorted by ({by}) into {buckets} buckets location '{place}'"
    )
    return spark.table(table)


def insert_clustered(source: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Add the source rows, one per key, whose key the table does not have; stored rows stay where they are.

    Only the source is shuffled. A null key is never there, as in `pending`. A second run adds nothing.
    """
    spark = source.sparkSession
    # Stored, so that the table is not read while it is written and the source runs once.
    fresh = stored(new_rows(spark.table(table), source, keys), "clustered")
    return write_clustered(fresh, table, path, keys, buckets)
