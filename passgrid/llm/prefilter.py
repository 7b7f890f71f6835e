"""A bounded filter before a join on hashed keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26


def _word(key: Column) -> Column:
    return F.shiftrightunsigned(key.bitwiseAND(F.lit((1 << BITS) - 1)), 6)


def likely_in(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose hash may be among ``keys``, for a join that would shuffle all the others in vain.

    The keys' last bits set marks in a map of ``2 ** BITS`` bits, kept as its words that aren't zero: 2 ** 20 rows at
    most, under 100 MB as Spark broadcasts them, however many keys there are. No row that has a key is lost; with far more
    keys than bits, all rows pass.
    """
    h = F.col(key)
    bit = F.expr(f"shiftleft(1L, CAST(`{key}` & 63 AS INT))")
    words = keys.filter(h.isNotNull()).select(_word(h).alias("_word"), bit.alias("_bit"))
    words = words.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    own = F.col(column)
    marked = F.expr(f"(_bits & shiftleft(1L, CAST(`{column}` & 63 AS INT))) != 0")
    return df.join(F.broadcast(words), (_word(own) == F.col("_word")) & marked, "left_semi")
