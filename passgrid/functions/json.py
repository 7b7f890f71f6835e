"""JSON in and out of columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Plain JSON only: no single quotes, no NaN literals.
STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def from_json_text(text: Column, schema: T.StructType, *, strict: bool = False) -> Column:
    """Decode JSON text by a schema. ``strict`` fails the query on bad text instead of giving NULL fields."""
    mode = "FAILFAST" if strict else "PERMISSIVE"
    return F.from_json(text, schema, {**STRICT_JSON, "mode": mode})


def to_json_text(value: Column) -> Column:
    return F.to_json(value)


def histogram_json(histogram: Column) -> Column:
    """``{"key":n,...}`` in key order, so equal histograms give equal text."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(histogram))))


def lenient_number(value: Column, type_name: str) -> Column:
    """A VARIANT as a number: numbers truncate, numeric text is read, true is 1, all else is 0."""
    as_double = F.try_variant_get(value, "$", "double")
    return F.coalesce(
        F.try_variant_get(value, "$", type_name),
        as_double.try_cast(type_name),
        F.lit(0).cast(type_name),
    )
