"""Latest-wins deduplication and duplicate checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def latest_wins(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """Keep one row per key: the greatest by ``newest_first``, compared left to right.

    The rank-equals-one filter becomes a group limit before the shuffle, so every input
    partition sends at most one row per key, however many rows one key holds.
    """
    order = [F.col(c).desc_nulls_last() for c in newest_first]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-null keys held by more than one row, with their row counts."""
    present = df.select(*keys).dropna(subset=list(keys))
    return present.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def duplicate_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of keys (a null key included) that occur more than once."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
    return groups.agg(F.count("*").alias("duplicate_keys"))
