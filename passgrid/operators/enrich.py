"""Enrichment and the detail projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passgrid.functions.text import dedup_key, mask_plate, vehicle_type
from passgrid.settings import DETAIL_COLUMNS

FILLED = ["xzqhmc", "kkmc", "fxlx", "hphm", "clppxh"]


def fill_missing(passes: DataFrame) -> DataFrame:
    """NULL text becomes the empty string."""
    return passes.fillna("", subset=FILLED)


def map_vehicle_type(passes: DataFrame) -> DataFrame:
    return passes.withColumn("hpzl", vehicle_type(F.col("hpzl")))


def add_plate_mask(passes: DataFrame, *, blank_is_absent: bool = False) -> DataFrame:
    return passes.withColumn(
        "hphm_mask", mask_plate(F.col("hphm_mask"), F.col("hphm"), blank_is_absent=blank_is_absent)
    )


def add_empty_tags(passes: DataFrame) -> DataFrame:
    return passes.withColumn("tags", F.create_map().cast("map<string,string>"))


def enrich_passes(passes: DataFrame) -> DataFrame:
    """Mask plates (from the raw plate), name vehicle types, fill missing text, add the empty tag map."""
    return add_empty_tags(fill_missing(map_vehicle_type(add_plate_mask(passes))))


def add_dedup_key(passes: DataFrame) -> DataFrame:
    return passes.withColumn(
        "dedup_key", dedup_key(F.col("gcxh"), F.col("hphm"), F.col("station_id"), F.col("gcsj"))
    )


def pass_detail(passes: DataFrame, *, created_at: Column | None = None) -> DataFrame:
    """The persisted columns: no raw plate, no serial id."""
    loaded = F.current_timestamp() if created_at is None else created_at
    return passes.select(*DETAIL_COLUMNS, loaded.alias("created_at"))
