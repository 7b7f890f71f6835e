"""Sharded Parquet tables.

A table of loads keeps each attempt to write a load in a folder of its own and then names its files in the commit log,
where they replace those of an earlier attempt. Readers open named files only, so they never see half a load, a load
written again replaces the whole of its old self, and a replayed batch adds nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passgrid.operators.merge import STATS_KEY, latest_per_key
from passgrid.session import stage
from passgrid.sinks.log import CommitLog


def write_sharded(df: DataFrame, path: str, *, time_col: str | None = None, order: Sequence[str] = ()) -> None:
    """One batch table partitioned by shard and, with ``time_col``, by day; files are sorted by ``order``, so that
    readers of few stations or hours skip most row groups.

    ``rebalance`` gathers each partition's rows in few files and, being adaptive, still splits a partition that holds
    much of the data.
    """
    parts = ["shard"]
    if time_col:
        df = df.withColumn("dt", F.to_date(time_col))
        parts = ["dt", "shard"]
    (
        df.hint("rebalance", *parts)
        .sortWithinPartitions(*parts, *order)
        .write.partitionBy(*parts)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .parquet(path)
    )


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step: readers see the old one or the new one."""
    jvm = spark.sparkContext._jvm
    place, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}._new")
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place.getParent())
    stream = part.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(part, True)
    stream.write(text.encode())
    stream.close()
    files.rename(part, place, options)


def append_load(df: DataFrame, path: str, load_id: int) -> None:
    """Add one load; ``df`` has a column ``shard``. The same id again replaces that load as a whole, also by fewer shards
    or by no rows."""
    log = CommitLog(df.sparkSession, path)
    folder = f"loads/load_id={load_id}/attempt={uuid.uuid4().hex}"
    df.write.partitionBy("shard").parquet(f"{path}/{folder}")
    log.commit({str(load_id): log.written(folder)}, df.schema.json())


def _committed(spark: SparkSession, path: str, up_to: int | None = None) -> DataFrame:
    """Rows of committed attempts, with ``load_id``. Only the files that the log names are looked at."""
    log = CommitLog(spark, path)
    table = log.read()
    columns = T.StructType.fromJson(json.loads(table.columns))
    files = [f for k, own in table.parts.items() if up_to is None or int(k) <= up_to for f in own]
    kind = T.StructType([*columns.fields, T.StructField("load_id", T.LongType())])
    if not files:
        return spark.createDataFrame([], kind).select("load_id", *columns.names)
    rows = spark.read.schema(kind).option("basePath", f"{path}/loads").parquet(*log.paths(files))
    return rows.select("load_id", *columns.names)


def read_loads(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table of loads."""
    return _committed(spark, path).drop("load_id")


def clean_loads(spark: SparkSession, path: str, *, older_than_s: float = 7 * 86_400) -> int:
    """Delete files of attempts that failed or were replaced, once they are that old; how many."""
    return CommitLog(spark, path).clean("loads", older_than_s=older_than_s)


def read_latest(spark: SparkSession, path: str, keys: Sequence[str] = STATS_KEY) -> DataFrame:
    """A keyed table after all loads: the latest row per key. Merges all loads on each read; see :mod:`keyed` for a table
    that is merged when it is written."""
    return latest_per_key(_committed(spark, path), keys, "load_id").drop("load_id")


def compact_loads(spark: SparkSession, path: str, out: str, *, up_to: int,
                  keys: Sequence[str] = STATS_KEY) -> None:
    """Merge the loads up to an id into one load at ``out``, to which later loads can be added."""
    append_load(latest_per_key(_committed(spark, path, up_to), keys, "load_id").drop("load_id"), out, up_to)


def load_batches(path: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: each micro-batch as a load under its number; a replayed one replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_load(batch, path, batch_id)

    return write


def split_batches(targets: dict[str, tuple[str, Sequence[str]]]) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: one micro-batch into several tables of loads, each ``path: (condition, columns)``.

    The batch is written once, beside the tables, and read back for each of them, so its source is read and parsed once
    whatever the number of targets. Each target takes its rows under the batch's number: after a failure between two
    targets the batch runs again and replaces what it had written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = stage(batch, "batch")
        for path, (condition, columns) in targets.items():
            append_load(parsed.filter(condition).select(*columns), path, batch_id)

    return write
