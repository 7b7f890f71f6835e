"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passgrid.functions.geo import has_geo
from passgrid.functions.text import has_text


def filter_essential(passes: DataFrame) -> DataFrame:
    """Passes with a positive station id and a time."""
    return passes.filter((F.col("station_id") > 0) & F.col("gcsj").isNotNull())


def filter_plate_present(passes: DataFrame) -> DataFrame:
    """Passes whose plate is neither NULL nor blank."""
    return passes.filter(has_text(F.col("hphm")))


def stations_with_geo(stations: DataFrame) -> DataFrame:
    return stations.filter(has_geo(F.col("lat"), F.col("lon")))
