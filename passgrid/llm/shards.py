"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by a hash of their text, then by a hash of their id, so that equal texts lie together and a large
group of them can still be cut. Splitters are found by counting exactly: each round divides every open interval of the
key into equal probes and sums bytes and rows below each of them, on a narrow table that is made once. An interval stays
open until its nearest probe is within tolerance of the wanted byte count, or it can't be divided. Then all rows are
exchanged once. Every step is a built-in expression.

The driver sees at most ``PROBES`` sums a splitter and round; there are at most ``MOST_PIECES`` splitters.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passgrid.llm.columns import fresh, quoted, without
from passgrid.session import stage

SHARDS = 40
ROW_BYTES = 16
TOLERANCE = 0.002
BITS = 8
PROBES = 1 << BITS
# The key is two unsigned numbers of 48 bits.
KEY_BITS = 48
PIECE_BYTES = 128 << 20
MOST_PIECES = 4096


def _unsigned(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - KEY_BITS)


def sized(docs: DataFrame, id_col: str, text_col: str, names: list[str]) -> DataFrame:
    """Adds size, unsigned crc32 and the two parts of the key."""
    size, crc, high, low = names
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    bytes_ = text.cast("binary")
    return docs.withColumns({
        size: (F.octet_length(text) + F.lit(ROW_BYTES)).cast("bigint"),
        crc: F.crc32(bytes_),
        high: _unsigned(F.xxhash64(bytes_)),
        low: _unsigned(F.xxhash64(F.coalesce(quoted(id_col).cast("string"), F.lit("")))),
    })


def _find(keys: DataFrame, targets: list[tuple[float, float]]) -> list[tuple[int, int, int, int]]:
    """For each target, wanted bytes and slack, the boundary whose bytes below come nearest, as soon as one within the
    slack is found: (high, low, bytes below, rows below).

    A boundary (high, low) has all rows with a smaller key below it.
    """
    # Boundaries with exact counts, refined between the neighbours of each target.
    end = 1 << KEY_BITS
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    known: dict[tuple[int, int], tuple[int, int]] = {(0, 0): (0, 0), (end, 0): (total["b"], total["n"])}

    def around(target: float) -> tuple[tuple[int, int], tuple[int, int]]:
        i = bisect_right(places, target, key=lambda p: known[p][0]) - 1
        i = min(max(i, 0), len(places) - 2)
        return places[i], places[i + 1]

    while True:
        places = sorted(known)
        open_: set[tuple[int, int, int, int]] = set()
        for target, slack in targets:
            a, b = around(target)
            if min(target - known[a][0], known[b][0] - target) <= slack:
                continue
            if known[b][1] - known[a][1] <= 1:
                continue
            # Intervals are (high range, all low) or (one high, low range), aligned to a power of two.
            if b[0] - a[0] > 1 or (b[0] - a[0] == 1 and a[1] == b[1] == 0):
                width = b[0] - a[0]
                if width > 1:
                    open_.add((0, a[0], 0, width.bit_length() - 1))
                else:
                    open_.add((1, a[0], 0, KEY_BITS))
            else:
                width = (b[1] or end) - a[1]
                if width > 1:
                    open_.add((1, a[0], a[1], width.bit_length() - 1))
        if not open_:
            break
        found = _count(keys, open_)
        for part, high, low, bits in open_:
            step = max(0, bits - BITS)
            a = (high, low)
            b_sum, n_sum = known[a]
            for probe in range(1 << (bits - step)):
                if part == 0:
                    place = (high + (probe << step), 0)
                else:
                    place = (high, low + (probe << step)) if low + (probe << step) < end else (high + 1, 0)
                known.setdefault(place, (b_sum, n_sum))
                b, n = found.get((part, high, low, probe), (0, 0))
                b_sum, n_sum = b_sum + b, n_sum + n
    out = []
    for target, _ in targets:
        a, b = around(target)
        best = a if target - known[a][0] <= known[b][0] - target else b
        out.append((*best, *known[best]))
    return out


def _count(keys: DataFrame, intervals: set[tuple[int, int, int, int]]) -> dict[tuple[int, int, int, int], tuple[int, int]]:
    """Bytes and rows between the probes of each interval."""
    by_kind: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for part, high, low, bits in intervals:
        by_kind.setdefault((part, bits), []).append((high, low))
    parts = []
    for (part, bits), starts in by_kind.items():
        step = max(0, bits - BITS)
        if part == 0:
            base = F.shiftleft(F.shiftright("high", bits), bits)
            inside = base.isin([h for h, _ in starts])
            high, low, value = base, F.lit(0).cast("bigint"), F.col("high") - base
        else:
            high = F.col("high")
            low = F.shiftleft(F.shiftright("low", bits), bits) if bits < KEY_BITS else F.lit(0).cast("bigint")
            pairs = [F.struct(F.lit(h).cast("bigint"), F.lit(v).cast("bigint")) for h, v in starts]
            inside = high.isin([h for h, _ in starts]) & F.struct(high, low).isin(pairs)
            value = F.col("low") - low
        parts.append(
            keys.filter(inside)
            .groupBy(F.lit(part).alias("part"), high.alias("h"), low.alias("l"), F.shiftright(value, step).alias("probe"))
            .agg(F.sum("size").alias("b"), F.count("*").alias("n"))
        )
    out = {}
    for p in parts:
        for r in p.collect():
            out[r["part"], r["h"], r["l"], r["probe"]] = (r["b"], r["n"])
    return out


def _boundaries_upto(places: list[tuple[int, int]], key: Column) -> Column:
    """How many of the sorted boundaries are not above the key, by binary search."""
    if not places:
        return F.lit(0)
    bounds = F.array(*[F.struct(F.lit(h).cast("bigint"), F.lit(v).cast("bigint")) for h, v in places])
    steps = F.array(*[F.lit(1 << i) for i in range(len(places).bit_length() - 1, -1, -1)])

    def further(at: Column, step: Column) -> Column:
        return at + F.when(F.get(bounds, at + step - 1) <= key, step).otherwise(0)

    return F.aggregate(steps, F.lit(0), further)


def shard_documents(
    docs: DataFrame,
    *,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = TOLERANCE,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """The documents with ``size, text_crc32, law, shard, slot, grown_shard``; columns of those names are replaced.

    The law is ``bytes``: sizes (UTF-8 bytes of the text, none for null, plus 16) of all shards differ from the mean by
    at most ``tolerance`` of it or, where single rows are larger, by what the nearest cut between rows allows. Equal
    texts stay together unless their group doesn't fit that. ``slot`` counts the rows of a shard from 0 in order of the
    key. ``grown_shard`` is null. Repeated rows are rows like any other; rows that are alike in id and text can't be
    told apart and aren't cut apart. Empty tables give no rows.

    A shard is written by as many tasks as it has pieces of ``piece_bytes``, ``MOST_PIECES`` in all at most.
    """
    out = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    columns = without(docs, out)
    size, crc, high, low = fresh(docs, "_size", "_crc", "_high", "_low")
    whole = sized(docs, id_col, text_col, [size, crc, high, low])
    keys = stage(
        whole.select(quoted(size).alias("size"), quoted(high).alias("high"), quoted(low).alias("low")), "keys"
    )
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    pieces = max(1, min(-(-total // (shards * piece_bytes)), MOST_PIECES // shards))
    cuts = shards * pieces
    slack = {True: total / shards * tolerance / 2, False: total / cuts / 8}
    found = _find(keys, [(total * i / cuts, slack[i % pieces == 0]) for i in range(1, cuts)])
    places = [(h, l) for h, l, _, _ in found]
    below = [0, *[n for *_, n in found]]
    piece, at = fresh(whole, "_piece", "_at")
    moved = (
        whole.withColumn(piece, _boundaries_upto(places, F.struct(quoted(high), quoted(low))))
        .repartitionById(cuts, quoted(piece))
        .sortWithinPartitions(high, low)
        .withColumn(at, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    start = F.array(*[F.lit(below[i] - below[i // pieces * pieces]).cast("bigint") for i in range(cuts)])
    shard = F.floor(quoted(piece) / pieces).cast("int")
    return moved.select(
        *columns,
        quoted(size).alias("size"),
        quoted(crc).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        shard.alias("shard"),
        (quoted(at) + F.element_at(start, quoted(piece) + 1)).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
