import random
import re

import numpy as np
import pyarrow as pa

from passgrid.llm import words as w
from passgrid.llm.fm_index import FMIndex, WaveletMatrix, suffix_array

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def texts(n, seed=1):
    rng = random.Random(seed)
    letters = "ab Z9é_.\n🙂 ß"
    return [None, "", " ", *["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]]


def test_words_are_those_of_the_pattern(monkeypatch):
    monkeypatch.setattr(w, "SLICE_BYTES", 100)
    data = texts(200)
    ids, back = {}, {}
    seen = 0
    for part in w.slices(pa.array(data)):
        for i in range(len(part.counts)):
            own = plain_words(data[part.first + i])
            hashes = part.hashes[part.bounds[i] : part.bounds[i + 1]].tolist()
            assert len(own) == len(hashes)
            for word, h in zip(own, hashes):
                assert ids.setdefault(word, h) == h
                assert back.setdefault(h, word) == word
            seen += 1
    assert seen == len(data)


def test_fingerprints_and_shingles_do_not_depend_on_the_place():
    data = ["A b, c d e f", "x y", "a B c d E F", "", "y x", "b c d e f"]
    (part,) = w.slices(pa.array(data))
    prints = part.fingerprints()
    assert prints[0] == prints[2] and len(set(prints[[0, 1, 4, 5]].tolist())) == 4
    shingles, bounds = part.shingles(5)
    sets = [set(shingles[a:b].tolist()) for a, b in zip(bounds, bounds[1:])]
    assert [len(s) for s in sets] == [2, 1, 2, 0, 1, 1]
    assert sets[0] == sets[2] and sets[5] < sets[0] and not sets[1] & sets[4]


def test_sliced_arrays():
    data = pa.array(["a", "b c", "d e f", None])
    (part,) = w.slices(data.slice(1, 2))
    assert part.counts.tolist() == [2, 3]


def naive_positions(segments, pattern):
    out, at = [], 0
    for s in segments:
        out += [at + i for i in range(len(s) - len(pattern) + 1) if s[i : i + len(pattern)] == pattern]
        at += len(s) + 1
    return out


def test_fm_index_finds_every_occurrence():
    rng = random.Random(2)
    for _ in range(30):
        segments = [[rng.randint(1, 4) for _ in range(rng.randint(1, 12))] for _ in range(rng.randint(1, 8))]
        segments += segments[:2]
        symbols = np.array([x for s in segments for x in [*s, 0]])
        patterns = [[rng.randint(1, 6) for _ in range(rng.randint(1, 4))] for _ in range(20)]
        patterns += [s[:3] for s in segments]
        lengths = np.array([len(p) for p in patterns])
        rows = np.zeros((len(patterns), 4), np.int64)
        for i, p in enumerate(patterns):
            rows[i, : len(p)] = p
        index = FMIndex(symbols)
        low, high = index.search(rows, lengths)
        for p, a, b in zip(patterns, low, high):
            assert sorted(index.locate(np.arange(a, b)).tolist()) == naive_positions(segments, p)


def test_suffix_array_and_ranks():
    symbols = np.array([3, 1, 2, 0, 3, 1, 2, 0, 1, 0])
    order = suffix_array(symbols).tolist()
    assert sorted(order) == list(range(10)) and order[:3] == [3, 7, 9]
    values = np.array([5, 0, 5, 2, 7, 5])
    tree = WaveletMatrix(values)
    for symbol in (0, 2, 5, 7, 3):
        got = tree.rank(np.full(7, symbol), np.arange(7)).tolist()
        assert got == [int((values[:i] == symbol).sum()) for i in range(7)]
