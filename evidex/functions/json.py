"""Values out of JSON texts. A text is parsed once into a VARIANT; what is not JSON, or not of the asked type, is null."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidex.functions.scalars import as_column


def json_variant(text: Column | str) -> Column:
    """The parsed text; null for a null or broken one. JSON's own null is a value (`is_variant_null`)."""
    return F.try_parse_json(as_column(text))


def json_value(variant: Column | str, path: str, to: str = "string") -> Column:
    """The value at a path such as `$.a.b[0]` of a parsed text, null where it is missing or cannot be of that type."""
    return F.try_variant_get(as_column(variant), path, to)


def json_columns(df: DataFrame, text: str, paths: Mapping[str, tuple[str, str]], valid: str | None = None) -> DataFrame:
    """All columns and one per name -> (path, type); `valid` names a column that says whether the text is JSON.

    The parsed text is only a column of this projection: nothing parses it again, and it is not stored.
    """
    kept = df.columns
    parsed = df.withColumn("_variant", json_variant(text))
    values = [json_value("_variant", path, to).alias(name) for name, (path, to) in paths.items()]
    checks = [F.col("_variant").isNotNull().alias(valid)] if valid else []
    return parsed.select(*kept, *values, *checks)


def json_schema(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """(keys, n, n_valid, schema): the type that holds all parsed texts of a group, without reading them to the driver."""
    parsed = df.select(*keys, json_variant(text).alias("_variant"))
    return parsed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count("_variant").alias("n_valid"), F.schema_of_variant_agg("_variant").alias("schema")
    )
