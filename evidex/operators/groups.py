"""Top-k per group that stays bounded when one group holds a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def topk_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str = "rank",
    salt_by: Column | None = None,
    salts: int = 16,
) -> DataFrame:
    """Keep the first k rows of each group and number them.

    Without `salt_by` this is one window; Spark then keeps at most k rows per group and map task before
    the shuffle, which suits mostly unique keys. With `salt_by` the groups are first cut down inside
    `salts` sub-groups in parallel, for few keys fed by very many tasks. Both give the same rows.
    """
    cut = df
    if salt_by is not None:
        inner = Window.partitionBy(*keys, "_salt").orderBy(*order)
        cut = (
            df.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)))
            .withColumn("_n", F.row_number().over(inner))
            .filter(F.col("_n") <= k)
            .drop("_salt", "_n")
        )
    window = Window.partitionBy(*keys).orderBy(*order)
    return cut.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
