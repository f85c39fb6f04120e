"""Object listings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_objects(spark: SparkSession, prefix: str, pattern: str = "*", with_content: bool = False) -> DataFrame:
    """Files below a prefix. Without content only the listing is read, not the files.

    Spark's file sources leave out files of zero length, which could give no chunk anyway.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(prefix)
    )
    columns = [F.col("path").alias("object_uri"), "length", "modificationTime"]
    return files.select(*columns, *(["content"] if with_content else []))


def object_catalog(*sources: DataFrame) -> DataFrame:
    """Every object URI once, from listings and registered URIs."""
    found = None
    for df in sources:
        uris = df.select("object_uri")
        found = uris if found is None else found.union(uris)
    return found.distinct()


def register_uris(spark: SparkSession, uris: Iterable[str], media_type: str) -> DataFrame:
    """A few literal URIs as rows for `insert_if_absent`."""
    rows = [(u, media_type) for u in uris]
    return spark.createDataFrame(rows, "object_uri string, media_type string")
