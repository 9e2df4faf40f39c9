"""Keep-first / keep-last per key.

``row_number() = 1`` is planned with a group limit on both sides of the
shuffle: each task sends at most one row per key, so a key that holds a third
of the table does not reach one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    spec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(spec)).filter("_rn = 1").drop("_rn")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _one_per_key(df, keys, [F.asc_nulls_last(c) for c in order])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows without an ``order`` value lose to rows that have one."""
    return _one_per_key(df, keys, [F.desc_nulls_last(c) for c in order])


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int) -> DataFrame:
    spec = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(spec)).filter(F.col("rank") <= n)
