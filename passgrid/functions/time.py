"""Time functions: strict instants, second buckets, gaps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO-8601 instant: date, T, time with seconds, up to nine decimals, Z or an offset with a colon.
_OFFSET = r"(Z|[+-](0\d|1[0-8]):[0-5]\d(:[0-5]\d)?)\z"
_DATE = r"\A\d{4}-\d{2}-\d{2}T"
_INSTANT = _DATE + r"([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d{1,9})?" + _OFFSET
_LEAP_SECOND = _DATE + r"23:59:60(\.\d{1,9})?" + _OFFSET
_END_OF_DAY = _DATE + r"24:00:00(\.0{1,9})?" + _OFFSET


def parse_instant(text: Column) -> Column:
    """Timestamp of a strict ISO-8601 instant, NULL for anything else.

    The pattern comes first because ``try_to_timestamp`` alone also takes ``2024`` or a time without zone.
    """
    t = F.upper(text)
    return (
        F.when(t.rlike(_INSTANT), F.try_to_timestamp(t))
        .when(t.rlike(_LEAP_SECOND), F.try_to_timestamp(F.regexp_replace(t, "T23:59:60", "T23:59:59")))
        .when(
            t.rlike(_END_OF_DAY),
            F.try_to_timestamp(F.regexp_replace(t, "T24:", "T00:")) + F.expr("INTERVAL '24' HOUR"),
        )
    )


def second_bucket(ts: Column) -> Column:
    """Epoch milliseconds over 1000, truncated toward zero."""
    return F.call_function("div", F.unix_millis(ts), F.lit(1000).cast("bigint"))


def time_gap_sec(a: Column, b: Column) -> Column:
    """Absolute difference of the whole epoch seconds (each floored first)."""
    return F.abs(F.unix_seconds(a) - F.unix_seconds(b))
