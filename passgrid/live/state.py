"""State of live queries as tables, to audit what a query remembers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dedup_keys(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The dedup keys that the query with this checkpoint holds after its last trigger, and until when: ``dedup_key,
    expires``. The query must have one operator with state, the dedup; the session's state store must be the query's."""
    held = spark.read.format("statestore").load(checkpoint)
    return held.select("key.dedup_key", F.timestamp_micros("value.expiresAtMicros").alias("expires"))


def held_history(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The plate histories that the query with this checkpoint holds: ``hphm, second``, a row per pass."""
    held = spark.read.format("statestore").option("stateVarName", "held").option("flattenCollectionTypes", "true").load(checkpoint)
    return held.select("list_element.value.hphm", "list_element.value.second")


def partition_rows(spark: SparkSession, checkpoint: str, *, operator: int = 0, side: str | None = None) -> DataFrame:
    """How many rows of state lie in each partition: ``partition, rows``; of a join, on one ``side``."""
    reader = spark.read.format("statestore").option("operatorId", str(operator))
    if side:
        reader = reader.option("joinSide", side)
    return reader.load(checkpoint).groupBy(F.col("partition_id").alias("partition")).agg(F.count("*").alias("rows"))
