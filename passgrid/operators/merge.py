"""Upserts as latest-wins merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATS_KEY = ["station_id", "window_start", "window_end"]


def latest_per_key(df: DataFrame, keys: Sequence[str], load_col: str) -> DataFrame:
    """The row with the greatest ``load_col`` per key, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), load_col).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
        .select(*df.columns)
    )


def upsert_stats(current: DataFrame, new: DataFrame, *, keys: Sequence[str] = STATS_KEY) -> DataFrame:
    """``current`` with rows of ``new`` added, replacing those of the same key. Each input has one row per key."""
    both = current.withColumn("_load", F.lit(0)).unionByName(new.withColumn("_load", F.lit(1)))
    return latest_per_key(both, keys, "_load").drop("_load")
