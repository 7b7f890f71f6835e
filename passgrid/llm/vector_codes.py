"""Vectors as short codes: codebooks by k-means whose assignments are kept exact with few distance calculations.

Components become integers, vectors are cut into parts, and each part position has a codebook of at most 256 entries. An
assignment round would compare each part with every entry. Instead each part keeps, from one round to the next, its
``b`` closest entries with ordered lower bounds of their distances and one outer bound for all other entries:

1. Bounds sink by how far an entry moved since; the outer bound by the farthest move of all.
2. The distance to the own entry is computed exactly. Entries whose bound lies above it, and all behind them, can't be
   nearer. If none is left the assignment stands.
3. Otherwise the first entries of the list are verified in integers, up to the first bound that holds; only where not
   even the outer bound holds, the part is compared with the whole codebook and its list made anew.
4. ``b`` is adapted after each round: the smallest list with which all but a twentieth of the parts would have been
   settled, between 4 and 32.

Each round reads a written table and writes the next one, vectors and bounds side by side, so no round shuffles vectors
and a lost executor costs its tasks only. Sums per entry are added up in each task and leave it as a thousand rows at most;
codebooks are that small too and reach the tasks with the function.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passgrid.llm.columns import fresh, quoted, without
from passgrid.operators.dimension import join_dimension
from passgrid.session import shared_dir, stage

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
FIRST_LIST, SHORTEST_LIST, LONGEST_LIST = 16, 4, 32
SETTLED = 0.95
BLOCK_ROWS = 4096

_ROW = ["_id", "_label", "_vector"]
_STATE = T.StructType([
    T.StructField("codes", T.ArrayType(T.ShortType())),
    T.StructField("near", T.ArrayType(T.ShortType())),
    T.StructField("low", T.ArrayType(T.FloatType())),
    T.StructField("outer", T.ArrayType(T.FloatType())),
    T.StructField("depth", T.ArrayType(T.ShortType())),
    T.StructField("error", T.LongType()),
])


def _down(x: np.ndarray) -> np.ndarray:
    """Single precision, never above ``x``; infinite stays infinite."""
    single = x.astype(np.float32)
    return np.where(np.isinf(x), single, np.nextafter(single, np.float32(-np.inf)))


def _root_up(squares: np.ndarray) -> np.ndarray:
    root = np.sqrt(squares.astype(np.float64))
    return np.nextafter(np.nextafter(root, np.inf), np.inf)


def _root_down(squares: np.ndarray) -> np.ndarray:
    root = np.sqrt(squares.astype(np.float64))
    return np.nextafter(np.nextafter(root, -np.inf), -np.inf)


def _all_distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row to every entry. Doubles hold the integers while they stay below 2**53."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    if 4 * x.shape[1] * most * most < 1 << 53:
        a, b = x.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    out = np.zeros((len(x), len(book)), np.int64)
    for d in range(x.shape[1]):
        out += (x[:, d, None] - book[None, :, d]) ** 2
    return out


@dataclass
class Bounds:
    """One part position of a block of rows. ``depth`` is how many listed entries the last round verified, one more than
    the list holds where the whole codebook was needed."""

    code: np.ndarray
    near: np.ndarray
    low: np.ndarray
    outer: np.ndarray
    depth: np.ndarray
    square: np.ndarray


def full_scan(x: np.ndarray, book: np.ndarray, b: int) -> Bounds:
    """Compare with the whole codebook. Lists are of the ``b`` closest other entries, or of all others if there are no
    more; entry 0 with an infinite bound fills a list up."""
    squares = _all_distances(x, book)
    code = squares.argmin(1)
    rows = np.arange(len(x))
    own = squares[rows, code]
    k = len(book)
    near, low = np.zeros((len(x), b), np.int16), np.full((len(x), b), np.inf, np.float32)
    outer = np.full(len(x), np.inf, np.float32)
    if k > 1:
        squares[rows, code] = np.iinfo(np.int64).max
        listed = min(b + 1, k - 1)
        at = np.argpartition(squares, listed - 1, axis=1)[:, :listed]
        order = np.argsort(np.take_along_axis(squares, at, 1), axis=1, kind="stable")
        at = np.take_along_axis(at, order, 1)
        bound = _down(_root_down(np.take_along_axis(squares, at, 1)))
        size = min(b, listed)
        near[:, :size], low[:, :size] = at[:, :size], bound[:, :size]
        if listed > b:
            outer = bound[:, b]
    return Bounds(code.astype(np.int16), near, low, outer, np.full(len(x), b + 1, np.int16), own)


def bounded_scan(x: np.ndarray, book: np.ndarray, moved: np.ndarray, old: Bounds, b: int) -> Bounds:
    """The assignment after the entries moved by ``moved``, with lists of ``b`` entries; exactly that of a full scan."""
    n, had = old.near.shape
    code = old.code.astype(np.int64)
    own = ((x - book[code]) ** 2).sum(1)
    low = old.low.astype(np.float64) - moved[old.near]
    outer = old.outer.astype(np.float64) - moved.max(initial=0.0)
    # What lies behind a place of the list may have come nearer than the place's own bound.
    behind = np.minimum.accumulate(np.concatenate([low, outer[:, None]], 1)[:, ::-1], axis=1)[:, ::-1]
    holds = _root_up(own)[:, None] < behind
    depth = np.where(holds.any(1), holds.argmax(1), had + 1)
    out = Bounds(code.copy(), old.near.copy(), _down(low), _down(outer), depth.astype(np.int16), own)
    reach = 0
    while reach < had:
        before, reach = reach, min(max(1, 2 * reach), had)
        at = np.flatnonzero((depth > before) & (depth <= reach))
        if not len(at):
            continue
        # The own entry and the first ``reach`` of the list, in the order of their exact distances, ties by index.
        entries = np.concatenate([code[at, None], old.near[at, :reach].astype(np.int64)], 1)
        empty = np.isinf(old.low[at, :reach])
        squares = ((x[at, None, :] - book[entries]) ** 2).sum(2)
        squares[:, 1:][empty] = np.iinfo(np.int64).max
        order = np.lexsort((entries, squares), axis=1)
        entries, squares = np.take_along_axis(entries, order, 1), np.take_along_axis(squares, order, 1)
        out.code[at], out.square[at] = entries[:, 0], squares[:, 0]
        out.near[at, :reach] = entries[:, 1:]
        bound = _down(_root_down(squares[:, 1:]))
        bound[squares[:, 1:] == np.iinfo(np.int64).max] = np.inf
        out.low[at, :reach] = bound
    if b < had:
        dropped = out.low[:, b:].min(1)
        out.near, out.low, out.outer = out.near[:, :b], out.low[:, :b], np.minimum(out.outer, dropped)
    elif b > had:
        filled = np.zeros((n, b), np.int16), np.full((n, b), np.inf, np.float32)
        filled[0][:, :had], filled[1][:, :had] = out.near, out.low
        # Unlisted entries stay behind the outer bound, so places without an entry must not end the list.
        out.near, out.low = filled
    whole = np.flatnonzero(depth > had)
    if len(whole):
        anew = full_scan(x[whole], book, b)
        out.code[whole], out.near[whole], out.low[whole] = anew.code, anew.near, anew.low
        out.outer[whole], out.square[whole] = anew.outer, anew.square
    out.code = out.code.astype(np.int16)
    return out


def _matrix(column: pa.Array, rows: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(rows, -1)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    flat = np.ascontiguousarray(values.reshape(len(values), -1))
    offsets = np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.reshape(-1), kind))


def _assign(books: list[np.ndarray], moved: list[np.ndarray] | None, b: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                n = batch.num_rows
                x = _matrix(batch.column("_vector"), n, np.int64).reshape(n, len(books), -1)
                if moved is None:
                    done = [full_scan(x[:, p], book, b) for p, book in enumerate(books)]
                else:
                    had = {c: _matrix(batch.column(c), n, t).reshape(n, len(books), -1) for c, t in (
                        ("codes", np.int16), ("near", np.int16), ("low", np.float32), ("outer", np.float32))}
                    done = [
                        bounded_scan(
                            x[:, p], book, moved[p],
                            Bounds(had["codes"][:, p, 0], had["near"][:, p], had["low"][:, p], had["outer"][:, p, 0], None, None),
                            b,
                        )
                        for p, book in enumerate(books)
                    ]
                columns = [batch.column(c) for c in _ROW]
                columns += [
                    _lists(np.stack([d.code for d in done], 1), pa.int16()),
                    _lists(np.stack([d.near for d in done], 1), pa.int16()),
                    _lists(np.stack([d.low for d in done], 1), pa.float32()),
                    _lists(np.stack([d.outer for d in done], 1), pa.float32()),
                    _lists(np.stack([d.depth for d in done], 1), pa.int16()),
                    pa.array(sum(d.square for d in done), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [*_ROW, *_STATE.names])

    return run


def _sums(parts: int, entries: int, width: int, longest: int):
    """Per task: sums and counts of each part position's entries, and how deep each part's list was verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * entries, width), np.int64)
        counts, depths = np.zeros(parts * entries, np.int64), np.zeros(longest + 2, np.int64)
        for batch in batches:
            n = batch.num_rows
            x = _matrix(batch.column("_vector"), n, np.int64).reshape(n * parts, width)
            codes = _matrix(batch.column("codes"), n, np.int64)
            key = (codes + np.arange(parts) * entries).reshape(-1)
            order = np.argsort(key, kind="stable")
            own, first = np.unique(key[order], return_index=True)
            if len(own):
                sums[own] += np.add.reduceat(x[order], first, axis=0)
                counts[own] += np.diff(np.append(first, len(key)))
            depths += np.bincount(_matrix(batch.column("depth"), n, np.int64).reshape(-1), minlength=len(depths))
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int32()), pa.array(counts[own], pa.int64()), _lists(sums[own], pa.int64())],
            ["entry", "n", "total"],
        )
        deep = np.flatnonzero(depths)
        yield pa.RecordBatch.from_arrays(
            [pa.array(-1 - deep, pa.int32()), pa.array(depths[deep], pa.int64()), _lists(np.zeros((len(deep), 0), np.int64), pa.int64())],
            ["entry", "n", "total"],
        )

    return run


def _refit(state: DataFrame, books: list[np.ndarray]) -> tuple[list[np.ndarray], dict[int, int]]:
    """Entries as floored means of their parts, unused ones as they were; and how many parts verified how many entries.
    At most a thousand entries' sums reach the driver."""
    parts, entries, width = len(books), len(books[0]), books[0].shape[1]
    schema = "entry int, n bigint, total array<bigint>"
    made = state.select("_vector", "codes", "depth").mapInArrow(_sums(parts, entries, width, LONGEST_LIST), schema)
    # Rows of depths have no totals.
    added = [F.sum(F.get("total", F.lit(d)).cast("decimal(38,0)")).alias(f"t{d}") for d in range(width)]
    out, depths = [book.copy() for book in books], {}
    for r in made.groupBy("entry").agg(F.sum("n").alias("n"), *added).collect():
        if r["entry"] < 0:
            depths[-1 - r["entry"]] = r["n"]
        else:
            p, e = divmod(r["entry"], entries)
            out[p][e] = [int(r[f"t{d}"]) // r["n"] for d in range(width)]
    return out, depths


def _next_list(depths: dict[int, int], b: int) -> int:
    """The shortest list that would have settled nearly all parts; twice as long where a list of ``b`` did not."""
    total, settled = sum(depths.values()), 0
    for depth in sorted(depths):
        settled += depths[depth]
        if settled >= SETTLED * total:
            wanted = 2 * b if depth > b else depth + 1
            return min(LONGEST_LIST, max(SHORTEST_LIST, wanted))
    return b


def integer_vectors(vectors: DataFrame, *, id_col: str, vector_col: str, label_col: str, parts: int = PARTS) -> DataFrame:
    """``_id, _label, _vector`` with components ``floor(1024 * x)`` in double precision, of the rows that can be coded.

    Left out are null vectors, those with null or non-finite components, those whose components are too large for exact
    64-bit distances (beyond 2**30 / sqrt(length) after scaling), and, where lengths differ, all vectors but those of the
    commonest length that can be cut into equal parts (of equally common ones the shortest).
    """
    vector = quoted(vector_col)
    sound = vector.isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    usable = vectors.filter(sound & (F.size(vector) > 0) & (F.size(vector) % parts == 0))
    width = usable.groupBy(F.size(vector).alias("width")).count().orderBy(F.desc("count"), "width").first()
    width = width["width"] if width else parts
    limit = isqrt((1 << 60) // width)
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    kept = usable.filter(
        (F.size(vector) == width) & ~F.exists(vector, lambda x: F.abs(x.cast("double") * SCALE) > F.lit(float(limit)))
    )
    return kept.select(
        quoted(id_col).alias("_id"), quoted(label_col).alias("_label"), scaled.cast("array<int>").alias("_vector")
    )


def code_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """One row per coded vector, ``id_col, label_col, codes, error``, and the final codebooks.

    The codebooks start as the parts of the ``entries`` smallest ids in ascending order (of fewer vectors all; null ids
    last; equal ids by vector). Each of ``rounds`` assigns every part to the nearest entry, ties to the lower index, and
    replaces used entries by the floored mean of their parts; at the end parts are assigned again. ``error`` is the sum of
    a vector's squared distances. Repeated rows count each. See :func:`integer_vectors` for rows that are left out; an
    empty table gives an empty result and empty codebooks.
    """
    spark = vectors.sparkSession
    state = stage(
        integer_vectors(vectors, id_col=id_col, vector_col=vector_col, label_col=label_col, parts=parts), "vectors"
    )
    first = state.orderBy(F.col("_id").asc_nulls_last(), "_vector").limit(entries).select("_vector").collect()
    if not first:
        empty = state.select(
            F.col("_id").alias(id_col), F.col("_label").alias(label_col),
            F.lit(None).cast("array<smallint>").alias("codes"), F.lit(None).cast("bigint").alias("error"),
        )
        return empty, [np.zeros((0, 0), np.int64)] * parts
    start = np.array([r[0] for r in first], np.int64).reshape(len(first), parts, -1)
    books = [np.ascontiguousarray(start[:, p]) for p in range(parts)]
    schema = T.StructType([*state.schema.fields, *_STATE.fields])
    moved, b, written = None, FIRST_LIST, None
    for round_ in range(rounds + 1):
        path = f"{shared_dir(spark, 'codes')}/data"
        state.mapInArrow(_assign(books, moved, b), schema).write.parquet(path)
        state = spark.read.schema(schema).parquet(path)
        if written:
            _remove(spark, written)
        written = path
        if round_ < rounds:
            fitted, depths = _refit(state, books)
            moved = [_root_up(((x - y) ** 2).sum(1)) for x, y in zip(fitted, books)]
            books, b = fitted, b if round_ == 0 else _next_list(depths, b)
    return state.select(
        F.col("_id").alias(id_col), F.col("_label").alias(label_col), "codes", "error"
    ), books


def _remove(spark, path: str) -> None:
    """Delete a round's table once the next one is written."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def code_text(codes: Column, parts: int = PARTS) -> Column:
    """Codes as two lowercase hexadecimal digits each."""
    return F.concat(*[F.lower(F.lpad(F.hex(codes[p].cast("bigint")), 2, "0")) for p in range(parts)])


def books_sha256(books: list[np.ndarray]) -> str:
    """Digest of all entries' components by part, entry and position, decimal and joined by commas."""
    return sha256(",".join(str(v) for book in books for v in book.reshape(-1).tolist()).encode()).hexdigest()


def with_label_errors(coded: DataFrame, label_col: str, out: str) -> DataFrame:
    """Adds the error summed over equal labels, nulls together; null where the sum is beyond 64 bits. Labels whose sums
    fit a broadcast are joined by one, others by a join whose hot labels are split."""
    (known, value, total) = fresh(coded, "_no_label", "_label_value", "_label_error")
    text = quoted(label_col).cast("string")
    keyed = coded.withColumns({known: quoted(label_col).isNull(), value: F.coalesce(text, F.lit(""))})
    sums = keyed.groupBy(known, value).agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias(total))
    joined = join_dimension(keyed, sums, [known, value], how="left")
    return joined.select(*without(coded, [out]), quoted(total).alias(out))
