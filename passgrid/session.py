"""Session options and the shared working area."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Options a cluster deployment should start with; nothing in the package depends on them for right results.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A task with rows of at most so many shards writes them as they come; one with more sorts them first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}
# Of these, the ones that keep live state on the executors' disks. Memory is that of all stores of an executor.
STORED_STATE = [
    "spark.sql.streaming.stateStore.providerClass",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows",
]


def use_local_scratch(spark: SparkSession) -> None:
    """Give a session that runs in one process a checkpoint folder, if it has none. A cluster must name a shared one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and re.match(r"local($|\[)", spark.sparkContext.master):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="passgrid-"))


def shared_dir(spark: SparkSession, label: str = "run") -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach. It goes when the driver ends."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    path = f"{root.rstrip('/')}/passgrid-{label}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return path


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, so that later passes do not repeat its work."""
    path = f"{shared_dir(df.sparkSession, label)}/data"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
