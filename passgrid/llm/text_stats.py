"""Counts over whole texts for quality rules, made slice by slice with NumPy.

A word here is a run of characters other than space and ``\\x09-\\x0D``. Lines are what lies between ``\\n``. Words, lines
and windows are compared by 64-bit hashes. A null text counts as empty: all counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passgrid.llm.columns import quoted
from passgrid.llm.words import Alphabet, Words, mix, range_hash, slices

WINDOW = 5

# Fixed value: characters counted as symbols.
SYMBOLS = "#*$%&|<>"

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_capitals",
    "n_digits", "n_marks", "n_bare_words", "n_marked_words",
]

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
PLAIN_WORDS = Alphabet(~_SPACES, np.arange(256, dtype=np.uint8))


def _table(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_SYMBOL = _table(SYMBOLS.encode())
_CAPITAL = _table(bytes(range(65, 91)))
_DIGIT = _table(b"0123456789")
_MARK = _table(bytes(c for c in range(33, 127) if not chr(c).isalnum()))
_NAMING = ~_MARK & ~_SPACES


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set within each pair of bounds."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _in_text(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that also tell the texts of a slice apart."""
    return mix(hashes + (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9FB21C651E98DF25))


def _distinct(keys: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Different keys of each text."""
    _, first = np.unique(keys, return_index=True)
    return np.bincount(text[first], minlength=texts)


def _repeat_words(words: Words) -> np.ndarray:
    """Words within five-word windows that their text holds twice or more."""
    n = len(words.bounds) - 1
    if not len(words.hashes):
        return np.zeros(n, np.int64)
    hashes, bounds = words.shingles(WINDOW)
    text = np.repeat(np.arange(n), np.diff(bounds))
    start = np.arange(bounds[-1]) - bounds[text] + words.bounds[text]
    full = words.counts[text] >= WINDOW
    hashes, text, start = hashes[full], text[full], start[full]
    _, back, times = np.unique(_in_text(hashes, text), return_inverse=True, return_counts=True)
    start = start[times[back] > 1]
    edges = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(edges, start, 1)
    np.add.at(edges, start + WINDOW, -1)
    return _per_text(np.cumsum(edges[:-1]) > 0, words.bounds)


def _lines(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and different ones among them, of each text."""
    n = len(words.bounds) - 1
    cuts = np.flatnonzero(words.data == 0x0A)
    starts = np.unique(np.concatenate([words.text_starts[:-1], cuts + 1]))
    starts = starts[starts < len(words.data)]
    ends = np.concatenate([starts[1:], [len(words.data)]])
    ends = ends - ((ends > starts) & (words.data[ends - 1] == 0x0A)) if len(starts) else ends[:0]
    wordy = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[wordy], ends[wordy]
    text = np.searchsorted(words.text_starts, starts, "right") - 1
    hashes = range_hash(words.data.astype(np.uint64) + np.uint64(1), starts, ends)
    return np.bincount(text, minlength=n), _distinct(_in_text(hashes, text), text, n)


def count_slice(words: Words) -> dict[str, np.ndarray]:
    """All counts for the texts of one slice."""
    n, data, at = len(words.bounds) - 1, words.data, words.text_starts
    text = words.text_of()
    chars = words.code_points(words.ends) - words.code_points(words.starts)
    ends = np.concatenate([[0], np.cumsum(chars)])
    naming = np.concatenate([[0], np.cumsum(_NAMING[data])])
    marks = np.concatenate([[0], np.cumsum(_MARK[data])])
    bare = naming[words.ends] == naming[words.starts]
    marked = (marks[words.ends] - marks[words.starts] >= 2) & ~bare
    lines, different = _lines(words)
    return {
        "n_words": words.counts,
        "word_chars": ends[words.bounds[1:]] - ends[words.bounds[:-1]],
        "n_symbols": _per_text(_SYMBOL[data], at),
        "n_dup_lines": lines - different,
        "n_repeat_words": _repeat_words(words),
        "n_lines": lines,
        "n_distinct_words": _distinct(_in_text(words.hashes, text), text, n),
        "n_capitals": _per_text(_CAPITAL[data], at),
        "n_digits": _per_text(_DIGIT[data], at),
        "n_marks": _per_text(_MARK[data], at),
        "n_bare_words": _per_text(bare, words.bounds),
        "n_marked_words": _per_text(marked, words.bounds),
    }


def _counter(at: int, columns: Sequence[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in slices(batch.column(at), PLAIN_WORDS):
                counts = count_slice(words)
                rows = batch.slice(words.first, len(words.bounds) - 1)
                arrays = [rows.column(i) for i in columns] + [pa.array(counts[c].astype(np.int64)) for c in COUNTS]
                names = [*(f"_kept_{i}" for i in range(len(columns))), *COUNTS]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def text_counts(docs: DataFrame, *, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the counts of each row's text, one row per row. A kept column named like a count gives
    way to it."""
    keep = [c for c in keep if c.lower() not in COUNTS]
    # The text stands apart from the kept columns, so that it may be one of them.
    fields = [T.StructField(f"_kept_{i}", docs.select(quoted(c)).schema[0].dataType) for i, c in enumerate(keep)]
    schema = T.StructType([*fields, *(T.StructField(c, T.LongType()) for c in COUNTS)])
    asked = docs.select(
        quoted(text_col).cast("string").alias("_text"), *[quoted(c).alias(f"_kept_{i}") for i, c in enumerate(keep)]
    )
    counted = asked.mapInArrow(_counter(0, range(1, len(keep) + 1)), schema)
    return counted.select(*[F.col(f"_kept_{i}").alias(c) for i, c in enumerate(keep)], *COUNTS)
