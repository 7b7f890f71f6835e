"""Traffic job, batch form: filter, enrich, dedup, then detail rows and station statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passgrid.operators.dedup import dedup_passes_ttl
from passgrid.operators.enrich import enrich_passes, pass_detail
from passgrid.operators.filters import filter_essential
from passgrid.operators.shard import shard_by_station
from passgrid.operators.stats import station_stats, stats_rows
from passgrid.settings import TrafficSettings
from passgrid.sinks.files import write_sharded
from passgrid.sources.passes import split_passes


@dataclass(frozen=True)
class TrafficTables:
    detail: DataFrame
    stats: DataFrame


def clean_passes(passes: DataFrame, settings: TrafficSettings = TrafficSettings(), *, order_col: str = "arrival_seq",
                 clock: str = "ingest_time") -> DataFrame:
    """Filtered, enriched passes without those that arrive again within ``dedup_hours`` of the one kept."""
    enriched = enrich_passes(filter_essential(passes))
    return dedup_passes_ttl(enriched, hours=settings.dedup_hours, clock=clock, order_col=order_col)


def traffic_tables(passes: DataFrame, settings: TrafficSettings = TrafficSettings(),
                   order_col: str = "arrival_seq", clock: str = "ingest_time") -> TrafficTables:
    """Both outputs as lazy DataFrames; each repeats the dedup. :func:`run_traffic` does it once."""
    clean = clean_passes(passes, settings, order_col=order_col, clock=clock)
    return TrafficTables(pass_detail(clean), stats_rows(station_stats(clean, settings.window)))


def run_traffic_records(records: DataFrame, out: str, settings: TrafficSettings = TrafficSettings()) -> TrafficTables:
    """From messages, with ``ingest_time`` and ``arrival_seq``: write ``out/rejects``, ``out/detail`` and ``out/stats``
    after one parse."""
    passes, rejects = split_passes(records, keep=["arrival_seq", "ingest_time"])
    rejects.write.parquet(f"{out}/rejects")
    return run_traffic(passes, out, settings)


def run_traffic(passes: DataFrame, out: str, settings: TrafficSettings = TrafficSettings(),
                order_col: str = "arrival_seq", clock: str = "ingest_time") -> TrafficTables:
    """Write ``out/detail`` and ``out/stats``. Statistics come from the written detail table, so the wide shuffle for
    the dedup happens once."""
    spark = passes.sparkSession
    clean = clean_passes(passes, settings, order_col=order_col, clock=clock)
    detail = shard_by_station(pass_detail(clean), settings.shards)
    write_sharded(detail, f"{out}/detail", time_col="gcsj", order=["station_id", "gcsj"])
    detail = spark.read.schema(detail.schema.add("dt", "date")).parquet(f"{out}/detail")
    stats = stats_rows(station_stats(detail, settings.window))
    stats = shard_by_station(stats, settings.shards)
    write_sharded(stats, f"{out}/stats", time_col="window_start", order=["station_id", "window_start"])
    return TrafficTables(detail, spark.read.schema(stats.schema.add("dt", "date")).parquet(f"{out}/stats"))
