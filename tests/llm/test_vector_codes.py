import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from passgrid.llm.vector_codes import (
    bounded_scan, books_sha256, code_text, code_vectors, full_scan, integer_vectors, with_label_errors,
)

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=4, entries=256, rounds=4):
    """(id, codes, error) and codebooks, every part against every entry in Python's integers."""
    kept = []
    for i, v, _ in rows:
        if v and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * x) for x in v]))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, v in kept[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for _, v in kept:
                groups[nearest(cut(v, p), books[p])[1]].append(cut(v, p))
            for e, own in groups.items():
                books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    found = [(i, [nearest(cut(v, p), books[p]) for p in range(parts)]) for i, v in kept]
    return sorted((repr(i), tuple(e for _, e in n), sum(d for d, _ in n)) for i, n in found), books


def check(spark, rows, **kind):
    coded, books = code_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), **kind)
    want, want_books = plain(rows, **kind)
    assert [b.tolist() for b in books] == want_books
    assert sorted((repr(r["vec_id"]), tuple(r["codes"]), r["error"]) for r in coded.collect()) == want
    return coded, books


def test_agrees_with_plain_k_means(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, 8)) * 0.2
    rows = [(i, (centers[i % 12] + rng.normal(size=8) * 0.03).tolist(), i % 3) for i in range(400)]
    rows += [(1000 + i, rows[7][1], None) for i in range(200)]  # a third of all rows is one vector
    rows += [rows[5], rows[5], (None, rows[9][1], 1), (2000, None, 1), (2001, [], 1), (2002, [0.1, None] * 4, 1)]
    rows += [(2003, [math.nan] * 8, 1), (2004, [math.inf] + [0.0] * 7, 2), (2005, [-1e-9] * 8, 2)]
    check(spark, rows)
    check(spark, rows, entries=40, rounds=6)


def test_few_rows_and_ties(spark):
    rows = [(i, [float(i // 2), 0.0, 0.0, 1.0], None) for i in range(6)]
    coded, books = check(spark, rows)
    assert len(books[0]) == 6
    got = with_label_errors(coded, "label", "label_error").collect()
    assert {r["label_error"] for r in got} == {0}
    check(spark, [(1, [0.5, 0.5, 0.5, 0.5], 1)])
    check(spark, [(i, [7e4 * (i % 7), -1e5, 3e4, i / 7], 1) for i in range(90)], entries=16)


def test_label_errors_and_digest(spark):
    rows = [(1, [0.0] * 4, 7), (2, [1.0] * 4, 7), (3, [2.0] * 4, None), (4, [4.0] * 4, None), (5, [9.0] * 4, 1)]
    coded, books = code_vectors(spark.createDataFrame(rows, SCHEMA), entries=1)
    assert books_sha256(books) == books_sha256([b.copy() for b in books]) and len(books_sha256(books)) == 64
    got = with_label_errors(coded, "label", "label_error").withColumn("code", code_text(F.col("codes"))).collect()
    errors, want = {r["vec_id"]: r["error"] for r in got}, defaultdict(int)
    for i, _, label in rows:
        want[label] += errors[i]
    assert {r["label"]: r["label_error"] for r in got} == want and {r["code"] for r in got} == {"00000000"}


def test_rows_that_cannot_be_coded(spark):
    rows = [(1, [0.0] * 4, 1), (2, [1.0] * 8, 1), (3, [2.0] * 8, 1), (4, [1.0] * 6, 1), (5, [1e300] * 8, 1)]
    frame = integer_vectors(spark.createDataFrame(rows, SCHEMA), id_col="vec_id", vector_col="embedding", label_col="label")
    assert sorted(r["_id"] for r in frame.collect()) == [2, 3]
    for empty in (rows[:0], [(1, None, None)]):
        coded, books = code_vectors(spark.createDataFrame(empty, SCHEMA))
        assert coded.count() == 0 and coded.columns == ["vec_id", "label", "codes", "error"] and len(books) == 4
        assert with_label_errors(coded, "label", "label_error").count() == 0


def test_clashing_columns(spark):
    rows = [(i, [i / 9, 0.1, 0.2, 0.3], "x", i) for i in range(5)]
    frame = spark.createDataFrame(rows, "codes long, error array<double>, _id string, _label int")
    with pytest.raises(Exception):
        frame.select("vec_id")
    coded, _ = code_vectors(
        frame.selectExpr("codes AS vec_id", "error AS embedding", "_id", "_label", "_label AS label", "'z' AS _vector"))
    assert coded.count() == 5


@pytest.mark.parametrize("seed", range(6))
def test_bounds_never_change_an_assignment(seed):
    rng = np.random.default_rng(seed)
    k, width, b = int(rng.integers(1, 60)), 5, 8
    x = rng.integers(-300, 300, (500, width)) // (1 if seed % 2 else 60)
    book = x[:k].copy()
    state = full_scan(x, book, b)
    skipped = 0
    for round_ in range(8):
        scale = (40 if seed % 2 else 1) / (round_ + 1)
        moved_book = book + np.round(rng.normal(size=book.shape) * scale * (rng.random((len(book), 1)) < 0.4)).astype(int)
        moved = np.nextafter(np.sqrt(((moved_book - book) ** 2).sum(1).astype(float)), np.inf)
        book, b = moved_book, [8, 4, 6, 3, 12, 5, 5, 9][round_]
        state = bounded_scan(x, book, moved, state, b)
        want = full_scan(x, book, b)
        assert (state.code == want.code).all() and (state.square == want.square).all()
        assert state.near.shape == (500, b)
        skipped += int((state.depth == 0).sum())
        # Every bound holds: no listed entry is nearer than its own bound, no other one than the outer bound.
        squares = ((x[:, None, :] - book[None]) ** 2).sum(2)
        for i in range(0, 500, 50):
            listed = {int(e) for e, low in zip(state.near[i], state.low[i]) if np.isfinite(low)}
            for e, low in zip(state.near[i], state.low[i]):
                assert not np.isfinite(low) or squares[i, e] >= low * low or low <= 0
            for e in set(range(len(book))) - listed - {int(state.code[i])}:
                assert state.outer[i] <= 0 or squares[i, e] >= state.outer[i] ** 2
    assert skipped > 0 or k == 1
