"""Plate-clone job: impossible speeds between passes of one plate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passgrid.functions.geo import clone_confidence, haversine_km, implied_speed_kmh, is_overspeed, order_pair
from passgrid.functions.text import mask_plate
from passgrid.functions.time import time_gap_sec
from passgrid.operators.dimension import join_dimension
from passgrid.operators.filters import filter_essential, filter_plate_present, stations_with_geo
from passgrid.operators.pairs import HOT_ROWS, hot_plate_splits, plate_pairs
from passgrid.operators.shard import shard_by_station
from passgrid.session import stage
from passgrid.settings import CloneSettings
from passgrid.sinks.files import write_sharded
from passgrid.sources.passes import split_narrow


def join_station(passes: DataFrame, stations: DataFrame, **join) -> DataFrame:
    """Add ``lat, lon`` of the pass's station; passes of unknown stations or ones without coordinates go."""
    located = stations_with_geo(stations).select("station_id", "lat", "lon")
    return join_dimension(passes, located, "station_id", how="inner", **join)


def locate_passes(passes: DataFrame, stations: DataFrame, *, order_col: str = "arrival_seq",
                  keep: Sequence[str] = ()) -> DataFrame:
    """What the pair join needs of each usable pass and no more: plate, station, time, order, coordinates, mask; and the
    columns of ``keep``."""
    usable = filter_plate_present(filter_essential(passes))
    mask = mask_plate(F.col("hphm_mask"), F.col("hphm"), blank_is_absent=True)
    columns = list(dict.fromkeys(["hphm", "station_id", "gcsj", order_col, *keep]))
    return join_station(usable.select(*columns, mask.alias("mask")), stations)


def score_pairs(pairs: DataFrame, max_speed_kmh: float = 140.0) -> DataFrame:
    """Alerts of the pairs that imply more than the speed limit; one per pair, none suppressed."""
    first, second = order_pair(
        F.col("cur_gcsj"), F.col("cur_station_id"), F.col("prev_gcsj"), F.col("prev_station_id")
    )
    gap = time_gap_sec(F.col("cur_gcsj"), F.col("prev_gcsj"))
    distance = haversine_km(F.col("cur_lat"), F.col("cur_lon"), F.col("prev_lat"), F.col("prev_lon"))
    # inline keeps the optimizer from moving the speed test into the join condition, where it would run before the time
    # band and once more for the output.
    measured = F.inline(F.array(F.struct(gap.alias("time_gap_sec"), distance.alias("distance_km"))))
    scored = pairs.select("*", measured).withColumn(
        "speed_kmh", implied_speed_kmh(F.col("distance_km"), F.col("time_gap_sec"))
    )
    return scored.filter(is_overspeed(F.col("speed_kmh"), max_speed_kmh)).select(
        first.alias("station_id"),
        F.col("cur_mask").alias("hphm_mask"),
        first.alias("first_station_id"),
        second.alias("second_station_id"),
        "time_gap_sec",
        "distance_km",
        "speed_kmh",
        clone_confidence(F.col("speed_kmh"), max_speed_kmh).alias("confidence"),
    )


def clone_alerts(
    passes: DataFrame,
    stations: DataFrame,
    settings: CloneSettings = CloneSettings(),
    *,
    order_col: str = "arrival_seq",
    hot_rows: int | None = HOT_ROWS,
    staged: bool = True,
) -> DataFrame:
    """Batch alerts of decoded passes.

    The input is read three times: once to find crowded plates and once per join side. ``staged`` writes the few columns
    needed to the shared folder first, so that decoding happens once. ``hot_rows=None`` skips the search.
    """
    located = locate_passes(passes, stations, order_col=order_col)
    if staged:
        located = stage(located, "clones")
    splits = None
    if hot_rows is not None:
        splits = hot_plate_splits(located, horizon_s=settings.horizon_s, hot_rows=hot_rows)
    pairs = plate_pairs(
        located,
        horizon_s=settings.horizon_s,
        min_gap_s=settings.min_gap_s,
        order_col=order_col,
        carry=["lat", "lon", "mask"],
        splits=splits,
    )
    return score_pairs(pairs, settings.max_speed_kmh)


def run_clone_records(records: DataFrame, stations: DataFrame, out: str,
                      settings: CloneSettings = CloneSettings()) -> DataFrame:
    """From messages, with ``arrival_seq``: write ``out/rejects`` and ``out/alerts`` after one parse."""
    passes, rejects = split_narrow(records, keep=["arrival_seq"])
    rejects.write.parquet(f"{out}/rejects")
    return run_clones(passes, stations, out, settings)


def run_clones(passes: DataFrame, stations: DataFrame, out: str, settings: CloneSettings = CloneSettings(),
               order_col: str = "arrival_seq") -> DataFrame:
    """Write ``out/alerts``."""
    alerts = clone_alerts(passes, stations, settings, order_col=order_col)
    alerts = alerts.withColumn("created_at", F.current_timestamp())
    alerts = shard_by_station(alerts, settings.shards)
    write_sharded(alerts, f"{out}/alerts", order=["hphm_mask"])
    return passes.sparkSession.read.schema(alerts.schema).parquet(f"{out}/alerts")
