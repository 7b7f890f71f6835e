"""Structured queries that never end.

The traffic job is two queries: a stream can carry one watermark per chain, and the dedup needs the ingest clock while
statistics need the pass time. The first writes the detail table, the second reads it as a stream. So passes too late
for their window still reach the detail table.

All three write with the Parquet file sink, whose commit log makes output exactly-once. The number of state partitions
is ``spark.sql.shuffle.partitions`` at the first start of a query and stays for its lifetime; choose it for the state of
the busiest day.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from passgrid.operators.dedup import stream_dedup_passes
from passgrid.operators.enrich import enrich_passes, pass_detail
from passgrid.live.history import history_stream
from passgrid.live.late import late_gate, united_partitions
from passgrid.operators.filters import filter_essential, filter_plate_present
from passgrid.operators.pairs import plate_pairs
from passgrid.operators.shard import shard_by_station
from passgrid.operators.stats import station_stats, stats_rows, with_pass_watermark
from passgrid.plans.clones import locate_passes, score_pairs
from passgrid.sinks.files import load_batches, split_batches
from passgrid.settings import DETAIL_SCHEMA, NARROW_FIELDS, CloneSettings, TrafficSettings
from passgrid.sources.passes import decode_passes, decode_passes_narrow, marked_narrow


def detail_stream(records: DataFrame, settings: TrafficSettings = TrafficSettings(),
                  clock: str | None = None) -> DataFrame:
    """Records to detail rows: decode, filter, enrich, dedup; ``clock`` as in :func:`stream_dedup_passes`."""
    passes = filter_essential(decode_passes(records, keep=["ingest_time"]))
    deduped = stream_dedup_passes(enrich_passes(passes), hours=settings.dedup_hours, clock=clock)
    return shard_by_station(pass_detail(deduped), settings.shards)


def stats_stream(detail: DataFrame, settings: TrafficSettings = TrafficSettings(), *,
                 count_late: bool = False) -> DataFrame:
    """Detail rows to closed station windows, each emitted once. With ``count_late`` the query's first operator counts
    the passes that come too late; see :func:`passgrid.live.late.late_gate`."""
    return _window_stream(with_pass_watermark(detail, settings.watermark_delay), settings, count_late)


def partitioned_stats_stream(partitions: Sequence[DataFrame], settings: TrafficSettings = TrafficSettings(), *,
                             count_late: bool = False) -> DataFrame:
    """As :func:`stats_stream` for the streams of several source partitions, each with a watermark of its own."""
    return _window_stream(united_partitions(partitions, settings.watermark_delay), settings, count_late)


def _window_stream(passes: DataFrame, settings: TrafficSettings, count_late: bool) -> DataFrame:
    if count_late:
        passes = late_gate(passes, settings.window)
    return shard_by_station(stats_rows(station_stats(passes, settings.window)), settings.shards)


def alert_stream(records: DataFrame, stations: DataFrame, settings: CloneSettings = CloneSettings(),
                 hot_plates: DataFrame | None = None, *, ingest_clock: bool = False) -> DataFrame:
    """Records to alerts, through a stream-stream join of the passes with themselves.

    State is kept by when a pass was seen, for ``retention_s``; the passes' own times only make pairs, so neither a clock
    in the future nor passes hours behind the others lose an alert. Seen means the time of the trigger, or with
    ``ingest_clock``, for replays at many times the original speed, the ingest time if that is earlier; there a pass
    more than ``watermark_delay`` behind the newest is lost. ``settings.bucket_s`` spreads the state of busy plates, known
    or not, over partitions by time; ``hot_plates`` (``hphm, splits``) spreads plates known to be busy further. State and join
    take packets of passes that one trigger brings, those of a crowd at one station apart; see
    :func:`passgrid.operators.pairs.history_pairs`. None of these may change while the query keeps its checkpoint.
    """
    keep = ["arrival_seq"] if "arrival_seq" in records.columns else []
    order_col = "arrival_seq" if keep else "gcsj"
    now = F.current_timestamp()
    seen = F.least(F.coalesce("ingest_time", now), now) if ingest_clock else now
    passes = decode_passes_narrow(records, keep=[*keep, "ingest_time"]).withColumn("seen", seen)
    located = locate_passes(passes, stations, order_col=order_col, keep=["seen"])
    pairs = plate_pairs(
        located,
        horizon_s=settings.horizon_s,
        min_gap_s=settings.min_gap_s,
        order_col=order_col,
        carry=["lat", "lon", "mask"],
        splits=hot_plates,
        retention_s=settings.retention_s,
        bucket_s=settings.bucket_s,
        watermark_delay=settings.watermark_delay,
    )
    alerts = score_pairs(pairs, settings.max_speed_kmh).withColumn("created_at", F.current_timestamp())
    return shard_by_station(alerts, settings.shards)


def reject_stream(records: DataFrame) -> DataFrame:
    """The messages that the clone job leaves out, bad times included, each with the reason."""
    return marked_narrow(records, keep=["ingest_time"]).filter("reject is not null").select(
        "ingest_time", "value", "reject"
    )


def read_detail_stream(spark: SparkSession, path: str) -> DataFrame:
    """The detail table as a stream. Each trigger takes all that was committed since, so never part of a batch. To start
    on a table with a long past, give a new query a folder that holds only the days wanted."""
    schema = T.StructType([*DETAIL_SCHEMA.fields, T.StructField("shard", T.IntegerType())])
    return spark.readStream.schema(schema).parquet(path).drop("shard")


def file_writer(df: DataFrame, path: str, checkpoint: str, *, available_now: bool = False,
                trigger: str = "30 seconds") -> DataStreamWriter:
    """Parquet files partitioned by shard."""
    writer = (
        df.writeStream.format("parquet")
        .partitionBy("shard")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)


def batch_writer(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, *,
                 available_now: bool = False, trigger: str = "30 seconds") -> DataStreamWriter:
    """Micro-batches through ``load_batches``, ``jdbc_batches`` or ``row_batches`` of the sinks."""
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)


def start_traffic(records: DataFrame, out: str, checkpoint: str, settings: TrafficSettings = TrafficSettings(),
                  **trigger) -> tuple[StreamingQuery, StreamingQuery]:
    """Start both traffic queries, writing ``out/detail`` and ``out/stats``."""
    return (
        start_detail(records, out, checkpoint, settings, **trigger),
        start_stats(records.sparkSession, out, checkpoint, settings, **trigger),
    )


def start_detail(records: DataFrame, out: str, checkpoint: str, settings: TrafficSettings = TrafficSettings(),
                 clock: str | None = None, **trigger) -> StreamingQuery:
    detail = detail_stream(records, settings, clock)
    return file_writer(detail, f"{out}/detail", f"{checkpoint}/detail", **trigger).start()


def start_stats(spark: SparkSession, out: str, checkpoint: str, settings: TrafficSettings = TrafficSettings(),
                *, name: str | None = None, count_late: bool = False, **trigger) -> StreamingQuery:
    """Write ``out/stats``. With a ``name`` and ``count_late``, a :class:`passgrid.live.late.LateCounts` that listens to
    the session accounts for late passes."""
    stats = stats_stream(read_detail_stream(spark, f"{out}/detail"), settings, count_late=count_late)
    writer = file_writer(stats, f"{out}/stats", f"{checkpoint}/stats", **trigger)
    return (writer.queryName(name) if name else writer).start()


def start_history(records: DataFrame, out: str, checkpoint: str, settings: CloneSettings = CloneSettings(),
                  **trigger) -> StreamingQuery:
    """Write ``out/history``, the size of each pass's plate history; records need ``arrival_seq``."""
    passes = decode_passes_narrow(records, keep=["arrival_seq", "ingest_time"])
    usable = filter_plate_present(filter_essential(passes))
    history = shard_by_station(history_stream(usable, settings), settings.shards)
    return file_writer(history, f"{out}/history", f"{checkpoint}/history", **trigger).start()


def start_stats_upsert(spark: SparkSession, out: str, checkpoint: str, settings: TrafficSettings = TrafficSettings(),
                       **trigger) -> StreamingQuery:
    """Statistics by key: each micro-batch is a load of ``out/stats_loads``, to be read with ``read_latest``."""
    stats = stats_stream(read_detail_stream(spark, f"{out}/detail"), settings)
    return batch_writer(stats, load_batches(f"{out}/stats_loads"), f"{checkpoint}/stats_loads", **trigger).start()


def start_rejects(records: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write ``out/rejects``, in a query of its own."""
    rejects = reject_stream(records).withColumn("shard", F.lit(0))
    return file_writer(rejects, f"{out}/rejects", f"{checkpoint}/rejects", **trigger).start()


def start_split(records: DataFrame, out: str, checkpoint: str, settings: CloneSettings = CloneSettings(),
                **trigger) -> StreamingQuery:
    """One query, one parse: passes to ``out/passes`` and messages left out, with the reason, to ``out/rejects``. Both are
    tables of loads, to be read with ``read_loads``; a batch that runs again replaces itself in both."""
    keep = [c for c in ("arrival_seq", "ingest_time") if c in records.columns]
    marked = shard_by_station(marked_narrow(records, keep=keep), settings.shards)
    marked = marked.withColumn("shard", F.coalesce("shard", F.lit(0)))
    write = split_batches({
        f"{out}/passes": ("reject is null", [*keep, *NARROW_FIELDS, "shard"]),
        f"{out}/rejects": ("reject is not null", [*keep, "value", "reject", "shard"]),
    })
    return batch_writer(marked, write, f"{checkpoint}/split", **trigger).start()


def start_alerts(records: DataFrame, stations: DataFrame, out: str, checkpoint: str,
                 settings: CloneSettings = CloneSettings(), hot_plates: DataFrame | None = None,
                 ingest_clock: bool = False, **trigger) -> StreamingQuery:
    alerts = alert_stream(records, stations, settings, hot_plates, ingest_clock=ingest_clock)
    return file_writer(alerts, f"{out}/alerts", f"{checkpoint}/alerts", **trigger).start()
