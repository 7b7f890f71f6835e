"""Words and word shingles of an Arrow text column as 64-bit hashes, without a Python object for each word.

A word is a run of bytes other than ``\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F`` after A-Z became a-z: digits, letters a-z
and every character beyond ASCII. Texts are taken in slices of about half a megabyte, a longer text as one slice of its
own; a slice needs about fifty times its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
WORD_CHARACTER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_BASE = 0x9E3779B97F4A7C15 | 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, bool)
_IS_WORD[0x00:0x30] = _IS_WORD[0x3A:0x61] = _IS_WORD[0x7B:0x80] = False


@dataclass(frozen=True, eq=False)
class Alphabet:
    """Which bytes belong to words, and what each byte counts as when words are compared."""

    inside: np.ndarray
    same_as: np.ndarray


LOWER_WORDS = Alphabet(_IS_WORD[_LOWER], _LOWER)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of 64-bit hashes (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _bytes_table() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(20, int(n).bit_length()))


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of ``values[s:e]``, independent of where the range lies."""
    up, down = _power_tables(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of consecutive texts. ``bounds[i]:bounds[i + 1]`` are those of text ``i``."""

    first: int
    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text_starts: np.ndarray
    data: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of(self) -> np.ndarray:
        """For each word, which text of the slice it belongs to."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def fingerprints(self) -> np.ndarray:
        """A hash of each text's sequence of words."""
        return range_hash(self.hashes, self.bounds[:-1], self.bounds[1:])

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of each text's runs of ``size`` words and their bounds; a text of fewer words, but not none, is one
        shingle. Repeats stay."""
        n = self.counts
        per_text = np.where(n >= size, n - size + 1, np.minimum(n, 1))
        bounds = np.concatenate([[0], np.cumsum(per_text)])
        at = np.repeat(self.bounds[:-1] - bounds[:-1], per_text) + np.arange(bounds[-1])
        width = np.repeat(np.minimum(n, size), per_text)
        return range_hash(self.hashes, at, at + width), bounds

    def code_points(self, offsets: np.ndarray) -> np.ndarray:
        """Byte offsets of the slice as characters from its beginning."""
        chars = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        return chars[offsets]


def slices(column: pa.Array, alphabet: Alphabet = LOWER_WORDS) -> Iterator[Words]:
    """The words of all texts of a column, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield _words(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], alphabet)
        first = last


def _words(first: int, data: np.ndarray, text_starts: np.ndarray, alphabet: Alphabet) -> Words:
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = alphabet.inside[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[text_starts] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    hashes = range_hash(_bytes_table()[alphabet.same_as[data]], starts, ends)
    return Words(first, hashes, np.searchsorted(starts, text_starts), starts, ends, text_starts, data)
