"""Watermarks per source partition, and an account of late rows."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from passgrid.operators.stats import with_pass_watermark
from passgrid.sinks.files import put_text

COUNTS_SCHEMA = "query string, run string, batch bigint, watermark string, late bigint"


def united_partitions(partitions: Sequence[DataFrame], delay: str = "120 seconds") -> DataFrame:
    """The streams of several source partitions as one, with a watermark each.

    The watermark of the union is the least of them (Spark's ``min`` policy for several watermarks, its default), so a
    partition that lags behind the others loses nothing, and one without rows holds all windows open. A Kafka topic has
    one stream per partition with the option ``assign``.
    """
    return reduce(DataFrame.unionByName, [with_pass_watermark(p, delay) for p in partitions])


def late_gate(passes: DataFrame, window: str = "30 seconds") -> DataFrame:
    """Passes with a watermark, without those whose window has closed. The window takes the place of the time in
    ``gcsj``, as a stream carries one event time; the window of a window of that length is the same.

    Statistics would drop the same ones, but count groups of them only, as they are combined before they meet the state.
    Here each pass meets a state of its own, so ``numRowsDroppedByWatermark`` is the number of late passes. Each is held
    until its window closes: some three minutes of passes with the usual delay.
    """
    # Spark seeds these ids once per trigger, so a task that runs again gives the same ones.
    gated = passes.withColumns({"gcsj": F.window("gcsj", window), "_row": F.expr("uuid()")})
    return gated.dropDuplicates(["gcsj", "_row"]).drop("_row")


class LateCounts(StreamingQueryListener):
    """Writes, per trigger of queries with a name, how many rows came too late for the first operator that dropped
    any; one small file per trigger with late rows below ``path``. A trigger that runs again replaces its file."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = next((op.numRowsDroppedByWatermark for op in p.stateOperators if op.numRowsDroppedByWatermark), 0)
        if p.name and late:
            row = {"query": p.name, "run": str(p.runId), "batch": p.batchId, "watermark": p.eventTime.get("watermark"),
                   "late": late}
            put_text(self.spark, f"{self.path}/query={uuid.uuid5(uuid.NAMESPACE_OID, p.name).hex}/{p.batchId}.json",
                     json.dumps(row) + "\n")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_late_counts(spark: SparkSession, path: str) -> DataFrame:
    """The account: ``query, run, batch, watermark, late``."""
    rows = spark.read.schema(COUNTS_SCHEMA).option("recursiveFileLookup", "true").json(path)
    return rows.withColumn("watermark", F.to_timestamp("watermark"))
