"""Text functions: blank test, trimming, vehicle types, plate masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values -------------------------------------------------------------------------------------------------

UNKNOWN_PLATE = "UNKNOWN"
UNKNOWN_TYPE = "未知车型"
VEHICLE_TYPES = {
    "1": "小型汽车",
    "2": "大型汽车",
    "13": "农用运输车",
    "-": "未知车型",
}
MASK_VISIBLE = 4
MASK_TAIL = "****"

_CONTROLS_AND_SPACE = "".join(chr(i) for i in range(0x21))


def has_text(c: Column) -> Column:
    """True when ``c`` holds a character that is not Unicode whitespace (U+3000 is, U+00A0 is not); false on NULL."""
    return F.coalesce(c.rlike(r"\P{javaWhitespace}"), F.lit(False))


def _needs_trim(c: Column) -> Column:
    return (F.substring(c, 1, 1) <= " ") | (F.substring(c, -1, 1) <= " ")


def trim_controls(c: Column) -> Column:
    """Strip characters up to U+0020 from both ends."""
    return F.when(_needs_trim(c), F.btrim(c, F.lit(_CONTROLS_AND_SPACE))).otherwise(c)


def _type_name(code: Column) -> Column:
    key, *others = VEHICLE_TYPES
    named = F.when(code == key, F.lit(VEHICLE_TYPES[key]))
    for key in others:
        named = named.when(code == key, F.lit(VEHICLE_TYPES[key]))
    return named.otherwise(code)


def vehicle_type(code: Column) -> Column:
    """Name of a vehicle type code; other text stays, trimmed; NULL is the unknown type.

    Codes without surrounding space, nearly all, never meet the trim, which costs more than the rest together.
    """
    return (
        F.when(code.isNull(), F.lit(UNKNOWN_TYPE))
        .when(_needs_trim(code), _type_name(trim_controls(code)))
        .otherwise(_type_name(code))
    )


def mask_plate(mask: Column, plate: Column, *, blank_is_absent: bool = False) -> Column:
    """The given mask if it has text, else one made from the plate.

    The traffic job calls a plate absent when it is empty, the clone job (``blank_is_absent``) when it is blank.
    """
    present = has_text(plate) if blank_is_absent else (F.length(plate) > 0)
    return (
        F.when(has_text(mask), mask)
        .when(present, F.concat(F.substring(plate, 1, MASK_VISIBLE), F.lit(MASK_TAIL)))
        .otherwise(F.lit(UNKNOWN_PLATE))
    )


def dedup_key(gcxh: Column, plate: Column, station_id: Column, gcsj: Column) -> Column:
    """``id:<gcxh>`` for a positive serial id, else ``plate|station|second``."""
    from passgrid.functions.time import second_bucket

    # coalesce, since concat_ws would leave a NULL part out
    fallback = F.concat_ws(
        "|",
        F.coalesce(plate, F.lit("")),
        station_id.cast("string"),
        F.coalesce(second_bucket(gcsj), F.lit(0)).cast("string"),
    )
    return F.when(gcxh > 0, F.concat(F.lit("id:"), gcxh.cast("string"))).otherwise(fallback)
