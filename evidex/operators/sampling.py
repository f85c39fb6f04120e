"""Repeatable sampling and per-key caps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidex.functions.scalars import SAMPLE_RESOLUTION, SEED, hash_bucket
from evidex.operators.groups import topk_per_group


def sample_position(id_col: str, seed: int = SEED) -> Column:
    """Place of an id in [0, 1); the same id and seed always land on the same place."""
    key = F.concat(F.col(id_col).cast("string"), F.lit(str(seed)))
    return hash_bucket(key, SAMPLE_RESOLUTION) / F.lit(float(SAMPLE_RESOLUTION))


def hash_sample(df: DataFrame, id_col: str, frac: float | None, seed: int = SEED) -> DataFrame:
    """Keep the ids placed below `frac`; None or 0 means no sampling. Growing `frac` only adds ids."""
    if not frac or frac <= 0.0:
        return df
    return df.filter(sample_position(id_col, seed) < F.lit(float(frac)))


def shuffled_order(id_col: str, tiebreak: Sequence[str] = (), seed: int = SEED) -> list[Column]:
    """A repeatable random order: by hash of id, tiebreak columns and seed, then by the tiebreak."""
    parts = [F.col(c).cast("string") for c in (id_col, *tiebreak)]
    return [F.sha2(F.concat_ws("|", *parts, F.lit(str(seed))), 256), *[F.col(c) for c in tiebreak]]


def cap_per_key(
    df: DataFrame,
    key: str,
    n: int,
    tiebreak: Sequence[str] = (),
    seed: int = SEED,
    rank: str = "rank",
) -> DataFrame:
    """At most n rows per key, chosen in the repeatable random order."""
    return topk_per_group(df, [key], shuffled_order(key, tiebreak, seed), n, rank)
