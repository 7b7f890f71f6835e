"""Decoding of pass messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passgrid.functions.json import STRICT_JSON, lenient_number
from passgrid.functions.time import parse_instant
from passgrid.session import stage
from passgrid.settings import NARROW_FIELDS, PASS_FIELDS, PASS_TYPES

_BAD = "_undecodable"
_NUMERIC = ("gcxh", "adcode", "station_id")


def _is_empty(value: Column) -> Column:
    return ~F.coalesce(value.rlike(r"[^\x00-\x20]"), F.lit(False))


def _parsed(records: DataFrame, fields: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One parse per message.

    ``inline`` rather than a struct column: the optimizer would copy ``from_json`` into every filter above a struct,
    but cannot move a filter below a generator. Numbers arrive as VARIANT to tell ``true`` from ``"true"``.
    """
    schema = T.StructType(
        [T.StructField(f, T.VariantType() if f in _NUMERIC else T.StringType()) for f in fields]
        + [T.StructField(_BAD, T.StringType())]
    )
    parsed = F.from_json("value", schema, {**STRICT_JSON, "columnNameOfCorruptRecord": _BAD})
    return records.select(*keep, F.inline(F.array(parsed)))


def _decode(records: DataFrame, fields: Sequence[str], ingest_time: Column, keep: Sequence[str],
            drop_bad_time: bool) -> DataFrame:
    marked = _marked(records, fields, ingest_time, keep, drop_bad_time, empty=False)
    return marked.filter(F.col("reject").isNull()).drop("reject")


def _marked(records: DataFrame, fields: Sequence[str], ingest_time: Column, keep: Sequence[str],
            drop_bad_time: bool, empty: bool = True) -> DataFrame:
    """Decoded rows with ``reject``: why a message is not used, or null."""
    # The time text keeps its own name until the fallback column is at hand.
    fallback = records.withColumn("_ingest", ingest_time).withColumn("_empty", _is_empty(F.col("value")))
    if not empty:
        fallback = fallback.filter(~F.col("_empty"))
    rows = _parsed(fallback, fields, [*keep, "_ingest", "_empty"])
    instant = parse_instant(F.col("gcsj"))
    if drop_bad_time:
        gcsj = F.when(F.col("gcsj").isNull(), F.col("_ingest")).otherwise(instant)
    else:
        gcsj = F.coalesce(instant, F.col("_ingest"))
    out = []
    for f in fields:
        if f in _NUMERIC:
            out.append(lenient_number(F.col(f), PASS_TYPES[f].simpleString()).alias(f))
        elif f == "gcsj":
            out.append(gcsj.alias(f))
        else:
            out.append(F.col(f))
    reject = F.when(F.col("_empty"), F.lit("empty")).when(F.col(_BAD).isNotNull(), F.lit("not json"))
    if drop_bad_time:
        reject = reject.when(gcsj.isNull(), F.lit("bad time"))
    return rows.select(*keep, *out, reject.alias("reject"))


def decode_passes(records: DataFrame, *, ingest_time: Column | str = "ingest_time",
                  keep: Sequence[str] = ()) -> DataFrame:
    """All eleven fields. A missing or unreadable time becomes the ingest time; messages that are no JSON object go to
    :func:`decode_rejects`. ``keep`` names record columns to carry along."""
    return _decode(records, PASS_FIELDS, _column(ingest_time), keep, drop_bad_time=False)


def decode_passes_narrow(records: DataFrame, *, ingest_time: Column | str = "ingest_time",
                         keep: Sequence[str] = ()) -> DataFrame:
    """The six fields of the clone job. A missing time becomes the ingest time; an unreadable one drops the message."""
    return _decode(records, NARROW_FIELDS, _column(ingest_time), keep, drop_bad_time=True)


def decode_rejects(records: DataFrame) -> DataFrame:
    """The messages that are no JSON object, unchanged."""
    empty = F.col("_empty")
    rows = records.withColumn("_empty", _is_empty(F.col("value")))
    schema = T.StructType([T.StructField(_BAD, T.StringType())])
    parsed = F.from_json("value", schema, {**STRICT_JSON, "columnNameOfCorruptRecord": _BAD})
    return (
        rows.select("*", F.inline(F.array(parsed)))
        .filter(empty | F.col(_BAD).isNotNull())
        .drop("_empty", _BAD)
    )


def _split(records: DataFrame, fields: Sequence[str], keep: Sequence[str], narrow: bool) -> tuple[DataFrame, DataFrame]:
    kept = list(dict.fromkeys([*keep, "value"]))
    marked = stage(_marked(records, fields, F.col("ingest_time"), kept, narrow), "decoded")
    passes = marked.filter(F.col("reject").isNull()).drop("reject", *([] if "value" in keep else ["value"]))
    return passes, marked.filter(F.col("reject").isNotNull()).select(*kept, "reject")


def split_passes(records: DataFrame, *, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Batch: :func:`decode_passes`, and the messages it leaves out with the reason, after one parse."""
    return _split(records, PASS_FIELDS, keep, narrow=False)


def split_narrow(records: DataFrame, *, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Batch: :func:`decode_passes_narrow`, and the messages it leaves out with the reason, after one parse."""
    return _split(records, NARROW_FIELDS, keep, narrow=True)


def marked_narrow(records: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    """Decoded messages of the clone job with ``value`` and ``reject``, for a live query that keeps both."""
    return _marked(records, NARROW_FIELDS, F.col("ingest_time"), [*keep, "value"], True)


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
