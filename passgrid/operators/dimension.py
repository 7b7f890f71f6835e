"""Joining facts with a dimension table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
KINDS = ("inner", "left", "left_semi", "left_anti")


def fits_broadcast(dim: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``dim`` stays within both bounds. Reads at most ``max_rows + 1`` of its rows."""
    size = F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    rows, total = (
        dim.limit(max_rows + 1)
        .select(size.alias("size"))
        .agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0)))
        .first()
    )
    return rows <= max_rows and total <= max_bytes


def join_dimension(
    facts: DataFrame,
    dim: DataFrame,
    key: str | Sequence[str],
    *,
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Equi-join (inner, left, left_semi or left_anti) with a dimension; ``key`` is a column or several.

    A dimension of checked size is broadcast, a larger one shuffled. There the facts of a hot key are split over several
    tasks by the adaptive skew join, which the allowed kinds all permit. The result is the same either way; a key on
    several rows of the dimension joins each of them.
    """
    if how not in KINDS:
        raise ValueError(f"how must be one of {KINDS}, not {how!r}")
    keys = [key] if isinstance(key, str) else list(key)
    if fits_broadcast(dim, max_rows, max_bytes):
        return facts.join(F.broadcast(dim), keys, how)
    return facts.join(dim.hint("merge"), keys, how)
