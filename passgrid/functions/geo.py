"""Distance, implied speed and alert scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0  # fixed value


def has_geo(lat: Column, lon: Column) -> Column:
    """True unless both coordinates are zero."""
    return (lat != 0.0) | (lon != 0.0)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; 0.0 when a coordinate is NaN."""
    any_nan = F.isnan(lat1) | F.isnan(lon1) | F.isnan(lat2) | F.isnan(lon2)
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    return F.when(any_nan, F.lit(0.0)).otherwise(2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(a), F.sqrt(1 - a)))


def implied_speed_kmh(distance_km: Column, gap_sec: Column) -> Column:
    """Distance over time; infinite for a zero gap.

    The guard stays even where a join keeps zero gaps out: the optimizer may compute the speed before that test.
    """
    return F.when(gap_sec == 0, F.lit(float("inf"))).otherwise(distance_km / (gap_sec / F.lit(3600.0)))


def is_overspeed(speed_kmh: Column, max_speed_kmh: float) -> Column:
    """NaN, from a coordinate that is no number, is no speed."""
    return (speed_kmh > F.lit(float(max_speed_kmh))) & ~F.isnan(speed_kmh)


def clone_confidence(speed_kmh: Column, max_speed_kmh: float) -> Column:
    """0.5 at the limit, growing with the excess, at most 1."""
    limit = F.lit(float(max_speed_kmh))
    return F.least(F.lit(1.0), (speed_kmh - limit) / limit + 0.5)


def order_pair(cur_ts: Column, cur_station: Column, prev_ts: Column, prev_station: Column) -> tuple[Column, Column]:
    """First and second station by event time; on a tie the current pass comes first."""
    cur_is_later = cur_ts > prev_ts
    return (
        F.when(cur_is_later, prev_station).otherwise(cur_station),
        F.when(cur_is_later, cur_station).otherwise(prev_station),
    )
