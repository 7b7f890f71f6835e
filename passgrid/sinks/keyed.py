"""Keyed Parquet tables that are merged when they are written.

Rows lie in buckets of time. An upsert reads and writes again the buckets that its rows touch and no others, so its cost
follows the change, and readers merge nothing. Which files a bucket has is in the commit log; an upsert that fails leaves
the table as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passgrid.operators.merge import STATS_KEY, latest_per_key
from passgrid.session import stage
from passgrid.sinks.log import CommitLog

BUCKET_S = 3600
_NEVER = "none"


def _bucket(time_col: str, seconds: int) -> Column:
    """The beginning of a row's bucket in seconds, as text; rows without a time share one."""
    start = F.floor(F.unix_seconds(F.col(time_col).cast("timestamp")) / seconds) * seconds
    return F.coalesce(start.cast("string"), F.lit(_NEVER))


def upsert_buckets(
    new: DataFrame,
    path: str,
    *,
    keys: Sequence[str] = STATS_KEY,
    time_col: str = "window_start",
    bucket_s: int = BUCKET_S,
    load_id: int | None = None,
) -> list[str]:
    """Add rows, replacing those of the same keys; ``time_col`` must be one of the keys. Which buckets were written.

    ``new`` has one row per key. The table's bucket size is that of its first upsert. With a ``load_id``, such as a batch's
    number, an upsert that was committed before is not done again; an older one isn't either.
    """
    spark = new.sparkSession
    log = CommitLog(spark, path)
    table = log.read()
    done = int(table.parts.get("_load", ["-1"])[0])
    if load_id is not None and load_id <= done:
        return []
    bucket_s = int(table.parts.get("_bucket_s", [str(bucket_s)])[0])
    added = stage(new.withColumn("_bucket", _bucket(time_col, bucket_s)), "upsert")
    touched = sorted(r[0] for r in added.select("_bucket").distinct().collect())
    held = [f for b in touched for f in table.parts.get(b, [])]
    both = added.withColumn("_load", F.lit(1))
    if held:
        before = spark.read.schema(new.schema).parquet(*log.paths(held))
        both = both.unionByName(before.withColumns({"_bucket": _bucket(time_col, bucket_s), "_load": F.lit(0)}))
    merged = latest_per_key(both, [*keys, "_bucket"], "_load").drop("_load")
    folder = f"data/attempt={uuid.uuid4().hex}"
    (
        merged.hint("rebalance", "_bucket").sortWithinPartitions("_bucket", *keys)
        .write.partitionBy("_bucket").parquet(f"{path}/{folder}")
    )
    parts: dict[str, list[str]] = {b: [] for b in touched}
    for f in log.written(folder):
        parts[f.split("/_bucket=")[1].split("/")[0]].append(f)
    if load_id is not None:
        parts["_load"] = [str(load_id)]
    log.commit({**parts, "_bucket_s": [str(bucket_s)]}, new.schema.json(), seen=table)
    return touched


def read_buckets(spark: SparkSession, path: str, *, since: int | None = None, until: int | None = None) -> DataFrame:
    """The table as it is, or the buckets that begin at ``since`` seconds or later and before ``until``; rows without a
    time only come with the whole table."""
    log = CommitLog(spark, path)
    table = log.read()
    columns = T.StructType.fromJson(json.loads(table.columns))

    def asked(bucket: str) -> bool:
        if bucket == _NEVER:
            return since is None and until is None
        return (since is None or int(bucket) >= since) and (until is None or int(bucket) < until)

    files = [f for b, own in table.parts.items() if not b.startswith("_") and asked(b) for f in own]
    if not files:
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).parquet(*log.paths(files))


def clean_buckets(spark: SparkSession, path: str, *, older_than_s: float = 7 * 86_400) -> int:
    """Delete files of replaced buckets and failed upserts, once they are that old; how many."""
    return CommitLog(spark, path).clean("data", older_than_s=older_than_s)


def upsert_batches(path: str, **kind):
    """For ``foreachBatch``: each micro-batch as an upsert under its number; a replayed one changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_buckets(batch, path, load_id=batch_id, **kind)

    return write
