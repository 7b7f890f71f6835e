"""Schemas and job parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---- Fixed values: field and column names of the JSON pass event and of the three output tables --------------------

TEXT_FIELDS = ["xzqhmc", "kkmc", "fxlx", "hpzl", "hphm", "hphm_mask", "clppxh"]
PASS_FIELDS = [
    "gcxh", "xzqhmc", "adcode", "kkmc", "station_id", "fxlx", "gcsj", "hpzl", "hphm", "hphm_mask", "clppxh",
]
NARROW_FIELDS = ["gcxh", "hphm", "hphm_mask", "station_id", "gcsj", "clppxh"]
DETAIL_COLUMNS = ["gcsj", "xzqhmc", "adcode", "kkmc", "station_id", "fxlx", "hpzl", "hphm_mask", "clppxh"]

DETAIL_SCHEMA = T.StructType([
    T.StructField("gcsj", T.TimestampType()),
    T.StructField("xzqhmc", T.StringType()),
    T.StructField("adcode", T.IntegerType()),
    T.StructField("kkmc", T.StringType()),
    T.StructField("station_id", T.IntegerType()),
    T.StructField("fxlx", T.StringType()),
    T.StructField("hpzl", T.StringType()),
    T.StructField("hphm_mask", T.StringType()),
    T.StructField("clppxh", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

STATS_SCHEMA = T.StructType([
    T.StructField("station_id", T.IntegerType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("cnt", T.LongType()),
    T.StructField("by_dir", T.StringType()),
    T.StructField("by_type", T.StringType()),
])

ALERT_SCHEMA = T.StructType([
    T.StructField("station_id", T.IntegerType()),
    T.StructField("hphm_mask", T.StringType()),
    T.StructField("first_station_id", T.IntegerType()),
    T.StructField("second_station_id", T.IntegerType()),
    T.StructField("time_gap_sec", T.LongType()),
    T.StructField("distance_km", T.DoubleType()),
    T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("created_at", T.TimestampType()),
])

# Records as the sources deliver them: the message text, when it reached the log, and its place in arrival order.
RECORD_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("ingest_time", T.TimestampType()),
    T.StructField("arrival_seq", T.LongType()),
])

PASS_TYPES = {"gcxh": T.LongType(), "adcode": T.IntegerType(), "station_id": T.IntegerType(),
              "gcsj": T.TimestampType()}


@dataclass(frozen=True)
class TrafficSettings:
    """Parameters of the traffic job. The defaults are fixed values."""

    watermark_delay: str = "120 seconds"
    window: str = "30 seconds"
    dedup_hours: int = 24
    shards: int = 2
    batch_size: int = 500


@dataclass(frozen=True)
class CloneSettings:
    """Parameters of the plate-clone job. The defaults are fixed values."""

    max_speed_kmh: float = 140.0
    min_gap_s: int = 20
    horizon_s: int = 2700
    # The live join forgets a pass so long after it was seen: the horizon and as much delay again.
    retention_s: int = 5400
    # Width of the time buckets that spread a plate's live state over partitions; without one the plate alone is the key.
    bucket_s: int | None = None
    # On the ingest clock, a pass this far behind the newest one is lost.
    watermark_delay: str = "45 minutes"
    shards: int = 2
