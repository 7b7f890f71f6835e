"""Benchmark decontamination by an FM-index per training shard.

A shard is a slice of the documents that a task reads. Its words become symbols: those of the benchmark's vocabulary a
number each, a stretch of any other word an end. Stretches shorter than the shortest test phrase can't hold one and are
left out; the rest is indexed. All phrases are searched backward through wavelet-tree ranks, their occurrences located
by sampled suffix positions and merged into removal spans. Nothing is shuffled.

The benchmark is the query set. Its items are cut into pieces of ``PIECE_WORDS`` words that overlap by less than a
phrase; equal pieces are one. Pieces are dealt into blocks of about ``BLOCK_ROWS`` pieces or ``BLOCK_WORDS`` words and
ids, whichever is less, each broadcast by itself and searched in a pass of its own over the shards; passes hand their
spans on within the row. Words and phrases are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passgrid.llm.columns import fresh, quoted, without
from passgrid.llm.fm_index import FMIndex
from passgrid.llm.words import Words, range_hash, slices
from passgrid.session import stage

WINDOW_WORDS = 13
BLOCK_ROWS, BLOCK_WORDS = 20_000, 1_000_000
PIECE_WORDS = 50_000
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


class Phrases:
    """Windows of a block of benchmark pieces, as rows of vocabulary numbers, and the items that hold each."""

    def __init__(self, pieces: pa.ListArray, ids: pa.ListArray, window: int):
        hashes = pieces.flatten().to_numpy().view(np.uint64)
        bounds = _list_bounds(pieces)
        n = np.diff(bounds)
        times = np.where(n >= window, n - window + 1, np.minimum(n, 1))
        first = np.concatenate([[0], np.cumsum(times)])
        starts = np.repeat(bounds[:-1] - first[:-1], times) + np.arange(first[-1])
        widths = np.repeat(np.minimum(n, window), times)
        _, one, which = np.unique(range_hash(hashes, starts, starts + widths), return_index=True, return_inverse=True)
        self.vocabulary, symbols = np.unique(hashes, return_inverse=True)
        self.lengths = widths[one]
        self.rows = np.zeros((len(one), window), np.int32)
        for k in range(window):
            long = np.flatnonzero(self.lengths > k)
            self.rows[long, k] = symbols[starts[one[long]] + k] + 1
        self.shortest = int(self.lengths.min(initial=window))
        pairs = np.unique(which * max(1, len(n)) + np.repeat(np.arange(len(n)), times))
        self._pieces = pairs % max(1, len(n))
        self._first = np.searchsorted(pairs // max(1, len(n)), np.arange(len(one) + 1))
        self._ids, self._id_bounds = ids.flatten().to_numpy(), _list_bounds(ids)

    def pieces(self, phrase: int) -> list[int]:
        return self._pieces[self._first[phrase] : self._first[phrase + 1]].tolist()

    def items(self, piece: int) -> list[int]:
        return self._ids[self._id_bounds[piece] : self._id_bounds[piece + 1]].tolist()


def _list_bounds(lists: pa.ListArray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)


def _cut(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Items as pieces of ``PIECE_WORDS`` word hashes at most; each window lies in one piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in slices(batch.column("phrase")):
                rows, parts = [], []
                for i, (a, b) in enumerate(zip(words.bounds.tolist(), words.bounds[1:].tolist())):
                    if a == b:
                        continue
                    for at in range(a, max(a + 1, b - window + 1), max(1, PIECE_WORDS - window + 1)):
                        rows.append(words.first + i)
                        parts.append(words.hashes[at : min(b, at + max(PIECE_WORDS, window))].view(np.int64))
                if rows:
                    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(offsets, np.concatenate(parts))
                    item = batch.column("item").take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([item, lists], ["item", "piece"])

    return run


def _asked(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> tuple[DataFrame, int]:
    """``piece, salt, ids`` of the benchmark's different pieces, as a written table, and how many blocks they make.

    A piece on many items is one row for each ``BLOCK_ROWS`` of the benchmark's pieces at most, so that no list of ids
    grows with the benchmark.
    """
    items = benchmark.select(
        quoted(item_col).cast("bigint").alias("item"), quoted(text_col).cast("string").alias("phrase")
    )
    pieces = stage(items.mapInArrow(_cut(window), "item bigint, piece array<bigint>"), "pieces")
    salts = max(1, -(-pieces.count() // BLOCK_ROWS))
    salt = F.pmod(F.xxhash64("item"), F.lit(salts)).alias("salt")
    asked = stage(pieces.groupBy("piece", salt).agg(F.collect_set("item").alias("ids")), "benchmark")
    rows, words = asked.agg(F.count("*"), F.coalesce(F.sum(F.size("piece") + F.size("ids")), F.lit(0))).first()
    return asked, max(1, -(-rows // BLOCK_ROWS), -(-words // BLOCK_WORDS))


def _occurrences(hashes: np.ndarray, text_of: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """First word and phrase of every occurrence."""
    none = np.zeros(0, np.int64)
    if not len(phrases.lengths) or not len(hashes):
        return none, none
    symbol = np.searchsorted(phrases.vocabulary, hashes)
    symbol[symbol == len(phrases.vocabulary)] = 0
    known = phrases.vocabulary[symbol] == hashes
    begins = known.copy()
    begins[1:] &= ~known[:-1] | (text_of[1:] != text_of[:-1])
    stops = known.copy()
    stops[:-1] &= ~known[1:] | (text_of[1:] != text_of[:-1])
    begins, stops = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    long = stops - begins >= phrases.shortest
    begins, stops = begins[long], stops[long]
    if not len(begins):
        return none, none
    sizes = stops - begins + 1
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    symbols = np.zeros(offsets[-1], np.int64)
    words = np.arange(offsets[-1]) + np.repeat(begins - offsets[:-1], sizes)
    inside = np.ones(offsets[-1], bool)
    inside[offsets[1:] - 1] = False
    symbols[inside] = symbol[words[inside]] + 1
    index = FMIndex(symbols)
    low, high = index.search(phrases.rows, phrases.lengths)
    times = high - low
    rows = np.arange(times.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(times)[:-1]]), times)
    return words[index.locate(rows)], np.repeat(np.arange(len(times)), times)


def _search(
    text: str, names: list[str], block, spans: str | None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the block's occurrences to the columns ``_n_words, _marks, _items``; the last block's search also turns all
    marks into the column ``spans``."""
    n_words, marks, items = names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = block.value
        for batch in batches:
            rest = [c for c in batch.schema.names if c not in (n_words, marks, items)]
            for words in slices(batch.column(text)):
                size = len(words.counts)
                text_of = words.text_of()
                at, phrase = _occurrences(words.hashes, text_of, phrases)
                cover = np.zeros(len(words.hashes) + 1, np.int64)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + phrases.lengths[phrase], -1)
                hit = np.cumsum(cover[:-1]) > 0
                part = batch.slice(words.first, size)
                before = part.column(marks).to_pylist()
                known = part.column(items).to_pylist()
                found: dict[int, set] = {}
                for t, p in np.unique(np.stack([text_of[at], phrase]), axis=1).T.tolist():
                    found.setdefault(t, set()).update(phrases.pieces(p))
                for t, own in found.items():
                    a, b = words.bounds[t], words.bounds[t + 1]
                    if before[t]:
                        for x, y in before[t]:
                            hit[a + x : a + y] = True
                    edge = np.diff(np.concatenate([[0], hit[a:b], [0]]))
                    before[t] = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
                    known[t] = sorted({*known[t], *(item for piece in own for item in phrases.items(piece))})
                merged = pa.array([[list(x) for x in y] for y in before], pa.list_(pa.list_(pa.int64())))
                columns = [part.column(c) for c in rest]
                columns += [pa.array(words.counts.astype(np.int64)), merged, pa.array(known, pa.list_(pa.int64()))]
                if spans:
                    columns.append(_places(words, before))
                yield pa.RecordBatch.from_arrays(columns, [*rest, n_words, marks, items, *([spans] if spans else [])])

    return run


def _places(words: Words, marks: list[list[tuple[int, int]]]) -> pa.Array:
    """Word spans as character offsets of their texts, end exclusive."""
    out, chars = [], None
    for t, own in enumerate(marks):
        row = []
        if own:
            if chars is None:
                chars = words.code_points(np.arange(len(words.data) + 1))
            zero, begin = chars[words.text_starts[t]], words.bounds[t]
            for a, b in own:
                start, end = words.starts[begin + a], words.ends[begin + b - 1]
                row.append({"start": int(chars[start] - zero), "end": int(chars[end] - zero)})
        out.append(row)
    return pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW_WORDS,
) -> DataFrame:
    """The documents with ``n_words, n_hit, items, spans, contaminated``; columns of those names are replaced.

    A phrase is a run of ``window`` words of an item, or all words of a shorter one; a document word inside any
    occurrence is hit. ``items`` are the sorted ids of items with occurring phrases, ``spans`` the merged occurrences as
    character offsets. A document is contaminated if at least a twentieth of its words, and one, is hit.

    Null, empty and wordless texts have no words and are not contaminated; such items have no phrases. Items without
    an id hit words but are not listed; an id on several rows stands for all of them. Ids must be integers. Repeated
    documents are rows like any other. An empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    out = ["n_words", "n_hit", "items", "spans", "contaminated"]
    if text_col.lower() in out:
        raise ValueError(f"the text column must not be called {text_col}")
    base = docs.select(*without(docs, out))
    text, n_words, marks, items, spans = fresh(base, "_text", "_n_words", "_marks", "_items", "_spans")
    found = base.withColumn(text, quoted(text_col).cast("string"))
    found = found.withColumn(n_words, F.lit(0).cast("bigint"))
    found = found.withColumn(marks, F.array().cast("array<array<bigint>>"))
    found = found.withColumn(items, F.array().cast("array<bigint>"))
    asked, blocks = _asked(benchmark, item_col, item_text_col, window)
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("piece", "salt"), F.lit(blocks)) == block).toArrow()
        phrases = Phrases(own["piece"].combine_chunks(), own["ids"].combine_chunks(), window)
        last = spans if block == blocks - 1 else None
        schema = T.StructType([*found.schema.fields, *([T.StructField(spans, SPAN)] if last else [])])
        shared = spark.sparkContext.broadcast(phrases)
        found = found.mapInArrow(_search(text, [n_words, marks, items], shared, last), schema)
    n_hit = F.aggregate(
        quoted(marks), F.lit(0).cast("bigint"), lambda n, s: n + F.element_at(s, 2) - F.element_at(s, 1)
    )
    (hit,) = fresh(found, "_hit")
    found = found.withColumn(hit, n_hit)
    return found.select(
        *[quoted(c) for c in base.columns],
        quoted(n_words).alias("n_words"),
        quoted(hit).alias("n_hit"),
        quoted(items).alias("items"),
        quoted(spans).alias("spans"),
        ((quoted(hit) > 0) & (quoted(hit) * 20 >= quoted(n_words))).alias("contaminated"),
    )
