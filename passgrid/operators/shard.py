"""Shard routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shard_by_station(df: DataFrame, shards: int = 2, *, station: str = "station_id") -> DataFrame:
    """Add ``shard`` = station id modulo ``shards``. Alerts carry their earlier station as ``station_id``."""
    return df.withColumn("shard", F.pmod(F.col(station), F.lit(shards)).cast("int"))
