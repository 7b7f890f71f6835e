"""Lookups in a dictionary table ``key, field, value``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passgrid.operators.dimension import join_dimension


def dictionary_entries(dictionary: DataFrame) -> DataFrame:
    """One row per key: ``key, entries`` with all its fields as a map in field order.

    A field has one value; should the table repeat it, the greatest is taken.
    """
    return (
        dictionary.groupBy("key", "field")
        .agg(F.max("value").alias("value"))
        .groupBy("key")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "value")))).alias("entries"))
    )


def dictionary_value(dictionary: DataFrame, field: str) -> DataFrame:
    """One row per key: ``key, value`` of a single field."""
    return dictionary.filter(F.col("field") == field).groupBy("key").agg(F.max("value").alias("value"))


def lookup_value(df: DataFrame, dictionary: DataFrame, *, key: str, field: str = "", into: str, **join) -> DataFrame:
    """Add the value of ``field`` under ``df[key]`` as column ``into``; NULL when the dictionary has none. A plain value,
    one under the key itself, has the empty field."""
    values = dictionary_value(dictionary, field).select(F.col("key").alias(key), F.col("value").alias(into))
    return join_dimension(df, values, key, how="left", **join)


def lookup_entries(df: DataFrame, dictionary: DataFrame, *, key: str, into: str, **join) -> DataFrame:
    """Add all fields under ``df[key]`` as a map; an empty map when the dictionary has none."""
    entries = dictionary_entries(dictionary).select(F.col("key").alias(key), F.col("entries").alias(into))
    joined = join_dimension(df, entries, key, how="left", **join)
    return joined.withColumn(into, F.coalesce(into, F.create_map().cast("map<string,string>")))
