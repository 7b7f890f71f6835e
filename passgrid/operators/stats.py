"""Station statistics over tumbling event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passgrid.functions.json import histogram_json

_DIR, _TYPE = 0, 1


def with_pass_watermark(passes: DataFrame, delay: str = "120 seconds") -> DataFrame:
    """Watermark on the pass time. Apply after ``filter_essential``: an undecodable message stamped with its ingest time
    must not push the watermark past a replay."""
    return passes.withWatermark("gcsj", delay)


def _window_columns(*more: Column) -> list[Column]:
    return [
        F.col("station_id"),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *more,
    ]


def station_window_count(passes: DataFrame, window: str = "30 seconds") -> DataFrame:
    """Passes per station and window."""
    counts = passes.groupBy(F.window("gcsj", window).alias("window"), "station_id").agg(F.count("*").alias("cnt"))
    return counts.select(*_window_columns(F.col("cnt")))


def _histogram(entries: str) -> Column:
    return F.map_from_entries(F.array_sort(entries))


def _station_histogram(passes: DataFrame, value: str, name: str, window: str) -> DataFrame:
    counts = passes.groupBy(
        F.window("gcsj", window).alias("window"), "station_id", F.coalesce(value, F.lit("")).alias("value")
    ).agg(F.count("*").alias("n"))
    return (
        counts.groupBy("window", "station_id")
        .agg(F.collect_list(F.struct("value", "n")).alias("entries"))
        .select(*_window_columns(_histogram("entries").alias(name)))
    )


def station_by_dir(passes: DataFrame, window: str = "30 seconds") -> DataFrame:
    """Passes per direction, as a map."""
    return _station_histogram(passes, "fxlx", "by_dir", window)


def station_by_type(passes: DataFrame, window: str = "30 seconds") -> DataFrame:
    """Passes per vehicle type, as a map."""
    return _station_histogram(passes, "hpzl", "by_type", window)


def station_stats(passes: DataFrame, window: str = "30 seconds") -> DataFrame:
    """Count, direction and type histograms per station and window.

    Each pass counts once under its direction and once under its type, so one partial aggregation before the shuffle
    serves both maps; the second aggregation sees one row per histogram entry, however busy the station.
    """
    facet = F.explode(F.array(
        F.struct(F.lit(_DIR).alias("kind"), F.coalesce("fxlx", F.lit("")).alias("value")),
        F.struct(F.lit(_TYPE).alias("kind"), F.coalesce("hpzl", F.lit("")).alias("value")),
    ))
    counts = (
        passes.select(F.window("gcsj", window).alias("window"), "station_id", "fxlx", "hpzl")
        .select("window", "station_id", facet.alias("facet"))
        .groupBy("window", "station_id", "facet.kind", "facet.value")
        .agg(F.count("*").alias("n"))
    )
    entry = F.struct("value", "n")
    merged = counts.groupBy("window", "station_id").agg(
        F.sum(F.when(F.col("kind") == _DIR, F.col("n"))).alias("cnt"),
        F.collect_list(F.when(F.col("kind") == _DIR, entry)).alias("dirs"),
        F.collect_list(F.when(F.col("kind") == _TYPE, entry)).alias("types"),
    )
    return merged.select(*_window_columns(
        F.col("cnt"), _histogram("dirs").alias("by_dir"), _histogram("types").alias("by_type")
    ))


def stats_rows(stats: DataFrame) -> DataFrame:
    """Statistics as stored: histograms as JSON text in key order."""
    return (
        stats.withColumn("by_dir", histogram_json(F.col("by_dir")))
        .withColumn("by_type", histogram_json(F.col("by_type")))
    )
