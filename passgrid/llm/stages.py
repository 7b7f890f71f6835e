"""From an operator's findings back to documents, for the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passgrid.llm.columns import fresh, quoted


INPUTS = ("doc_id", "text", "source")


def _apart(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """The documents with their further columns renamed, so that findings can't replace any, and the way back."""
    names = [c if c in INPUTS else f"_column_{i}" for i, c in enumerate(docs.columns)]
    renamed = docs.select(*[quoted(c).alias(n) for c, n in zip(docs.columns, names)])
    return renamed, [quoted(n).alias(c) for c, n in zip(docs.columns, names)]


def only(docs: DataFrame, operator: Callable[[DataFrame], DataFrame], condition: str) -> DataFrame:
    """The documents whose findings meet the condition, with their own columns."""
    apart, back = _apart(docs)
    return operator(apart).filter(condition).select(*back)


def copied(docs: DataFrame, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Each document ``copies`` times."""
    apart, back = _apart(docs)
    mixed = operator(apart).filter("copies > 0")
    (number,) = fresh(mixed, "_number")
    return mixed.withColumn(number, F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*back)
