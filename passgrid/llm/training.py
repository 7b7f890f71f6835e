"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passgrid.llm.columns import fold, quoted
from passgrid.session import stage

_SCALE = 1_000_000


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, *, id_col: str, rows: int, extra: tuple[str, ...] = ("text",)
) -> DataFrame:
    """``id, part, label`` and the extra columns of about ``rows`` labelled documents at most, chosen by a hash of the id.

    Only rows with a label of 0 or 1 whose crc32(id as text) modulo 5, ``part``, is not 0 take part; of several
    labels the largest counts. The documents are joined with the chosen ids by broadcast, whose size ``rows`` bounds.
    """
    asked = (
        labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("int").alias("label"))
        .filter("id is not null and label in (0, 1)")
        .withColumn("part", fold(F.col("id")))
        .filter("part > 0")
        .groupBy("id", "part")
        .agg(F.max("label").cast("double").alias("label"))
    )
    asked = stage(asked, "labels")
    total = asked.count()
    share = _SCALE if total <= rows else int(_SCALE * rows / total)
    chosen = asked.filter(F.pmod(F.xxhash64("id"), F.lit(_SCALE)) < share)
    texts = docs.select(quoted(id_col).alias("id"), *[quoted(c).alias(c) for c in extra])
    return stage(texts.join(F.broadcast(chosen), "id"), "training")
