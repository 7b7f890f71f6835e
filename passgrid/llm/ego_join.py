"""Near duplicates among vectors by epsilon grid order.

Unit vectors with a cosine of at least t lie within eps = sqrt(2 - 2t). They are laid on a grid of width eps over the
leading principal axes and sorted by cell, dimension after dimension; the sequence is cut into blocks. Blocks meet if
their first cells are neighbours and their bounding boxes lie within eps; two blocks are joined by halving intervals of
the sequence, skipping those whose boxes are too far apart, down to small products of matrices. A box holds the leading
coordinates and the length of the rest, so its distance never exceeds the true one.

Equal vectors of a label form a class and are compared once. A task returns for each class how many it is linked to and
a spanning forest, never all pairs. The axes are fitted on a bounded sample; they decide what can be skipped, not
what is found. Classes are identified by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passgrid.llm.columns import quoted
from passgrid.llm.links import join_crowded, resolve
from passgrid.session import stage

THRESHOLD = 0.98
SAMPLE_ROWS = 10_000
AXES = 8
BLOCK_ROWS = 2048
LEAF_ROWS = 128


def _units(column: pa.ListArray, size: int) -> np.ndarray:
    """Rows of length one, in double precision."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _principal_axes(sample: pa.Table) -> dict[int, np.ndarray]:
    """For each length of vectors, the directions in which they spread most."""
    sizes = np.array(sample["size"])
    axes = {}
    for size in np.unique(sizes).tolist():
        units = _units(sample["vector"].combine_chunks().take(pa.array(np.flatnonzero(sizes == size))), size)
        _, directions = np.linalg.eigh(units.T @ units)
        axes[size] = directions[:, ::-1][:, :AXES]
    return axes


def _project(units: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    """Leading coordinates and the length of what they leave."""
    own = axes.get(units.shape[1], np.eye(units.shape[1], min(AXES, units.shape[1])))
    lead = units @ own
    rest = np.sqrt(np.maximum(0, 1 - (lead * lead).sum(axis=1)))
    return np.column_stack([lead, rest])


def _cells(axes: dict[int, np.ndarray], eps: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array(batch["size"])
            cells: list = [None] * len(sizes)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                lead = _project(_units(batch["vector"].take(pa.array(at)), size), axes)[:, :-1]
                for i, cell in zip(at.tolist(), np.floor(lead / eps).astype(np.int32).tolist()):
                    cells[i] = cell
            column = pa.array(cells, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "cells"])

    return run


def _blocks(axes: dict[int, np.ndarray], rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts the sorted sequence of a partition into blocks of one label and length."""

    def block(part: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(part).combine_chunks()
        size = table["size"][0].as_py()
        box = _project(_units(table["vector"].combine_chunks(), size), axes)
        vectors = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return pa.RecordBatch.from_pydict({
            "group": [table["group"][0].as_py()],
            "size": pa.array([size], pa.int32()),
            "block": [int(table["cls"][0].as_py())],
            "low": [box.min(axis=0).tolist()],
            "high": [box.max(axis=0).tolist()],
            "cls": [table["cls"].to_numpy().astype(np.int64).tobytes()],
            "members": [table["members"].to_numpy().astype(np.int64).tobytes()],
            "vectors": [vectors.tobytes()],
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count, key = 0, None
        for batch in batches:
            keys = np.array(batch["group"])
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if held and (key != keys[a] or count >= rows):
                    yield block(held)
                    held, count = [], 0
                key = keys[a] if b > a else key
                while b - a:
                    take = min(b - a, rows - count)
                    held.append(batch.slice(a, take))
                    a, count = a + take, count + take
                    if count >= rows and b - a:
                        yield block(held)
                        held, count = [], 0
        if held:
            yield block(held)

    return run


class _Sequence:
    """A block in grid order, with the boxes of its intervals."""

    def __init__(self, row: dict, axes: dict[int, np.ndarray]):
        self.cls = np.frombuffer(row["cls"], np.int64)
        self.members = np.frombuffer(row["members"], np.int64)
        values = pa.array(np.frombuffer(row["vectors"], np.float64))
        self.units = _units(pa.FixedSizeListArray.from_arrays(values, row["size"]), row["size"])
        self.boxes = _project(self.units, axes)
        self.known: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def box(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        if (a, b) not in self.known:
            self.known[a, b] = (self.boxes[a:b].min(axis=0), self.boxes[a:b].max(axis=0))
        return self.known[a, b]


def _close(x: _Sequence, y: _Sequence, threshold: float, eps: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of pairs that reach the threshold; in one block, each pair once."""
    same = x is y
    open_ = [(0, len(x.cls), 0, len(y.cls))]
    while open_:
        a, b, c, d = open_.pop()
        if same and a >= d:
            continue
        (low, high), (other_low, other_high) = x.box(a, b), y.box(c, d)
        gap = np.maximum(0, np.maximum(low - other_high, other_low - high))
        # A hair of slack, as coordinates are rounded.
        if gap @ gap > eps * eps + 1e-9:
            continue
        if b - a <= LEAF_ROWS and d - c <= LEAF_ROWS:
            i, j = np.nonzero(x.units[a:b] @ y.units[c:d].T >= threshold)
            i, j = i + a, j + c
            yield (i[i < j], j[i < j]) if same else (i, j)
        elif b - a >= d - c:
            m = (a + b) // 2
            open_ += [(a, m, c, d), (m, b, c, d)]
        else:
            m = (c + d) // 2
            open_ += [(a, b, c, m), (a, b, m, d)]


def _join(axes: dict, threshold: float, eps: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def links(x: _Sequence, y: _Sequence) -> dict[str, np.ndarray]:
        n = len(x.cls)
        members = x.members if x is y else np.concatenate([x.members, y.members])
        cls = x.cls if x is y else np.concatenate([x.cls, y.cls])
        linked = np.zeros(len(cls), np.int64)
        parent = list(range(len(cls)))

        def top(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for i, j in _close(x, y, threshold, eps):
            j = j if x is y else j + n
            np.add.at(linked, i, members[j])
            np.add.at(linked, j, members[i])
            for p, q in zip(i.tolist(), j.tolist()):
                p, q = top(p), top(q)
                if p != q:
                    parent[max(p, q)] = min(p, q)
        hit = np.flatnonzero(linked)
        return {"cls": cls[hit], "linked": linked[hit], "other": cls[[top(i) for i in hit.tolist()]]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                x = _Sequence({k: row[f"a_{k}"] for k in ("size", "cls", "members", "vectors")}, axes)
                y = x
                if row["a_block"] != row["b_block"]:
                    y = _Sequence({k: row[f"b_{k}"] for k in ("size", "cls", "members", "vectors")}, axes)
                yield pa.RecordBatch.from_pydict(links(x, y))

    return run


def near_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every vector.

    Two vectors of one label and length are linked if their cosine in double precision is at least ``threshold``.
    ``n_links`` counts the vectors linked directly, ``component_id`` is the smallest id reachable, ``kept`` whether
    it is the vector's own. A vector that is null, empty, zero or holds a null, NaN or infinite component, or has a null
    label, links with nothing and is its own component. Equal vectors are linked to each other; repeated rows count as
    copies. A null id is never the smallest unless all are null. Other columns are ignored.
    """
    eps = sqrt(2 - 2 * threshold)
    own = quoted(vector_col).cast("array<double>")
    rows = vectors.select(
        quoted(id_col).cast("bigint").alias("vec_id"), quoted(label_col).cast("string").alias("label"),
        F.transform(own, lambda v: v + F.lit(0.0)).alias("vector"),
    )
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    fine &= F.exists("vector", lambda v: v != 0) & F.col("label").isNotNull()
    rows = stage(
        rows.withColumn("cls", F.when(F.coalesce(fine, F.lit(False)), F.xxhash64("label", "vector"))), "vectors"
    )
    classes = stage(
        rows.filter("cls is not null")
        .groupBy("cls")
        .agg(
            F.min("vec_id").alias("class_id"), F.count("*").alias("members"), F.first("vector").alias("vector"),
            F.first("label").alias("label"),
        )
        .withColumn("size", F.size("vector"))
        .withColumn("group", F.xxhash64("label", "size")),
        "classes",
    )
    scale = 1_000_000
    share = min(scale, int(scale * SAMPLE_ROWS / max(1, classes.count())))
    sample = classes.filter(F.pmod(F.xxhash64("cls"), F.lit(scale)) < share).select("size", "vector").toArrow()
    axes = _principal_axes(sample) if len(sample) else {}

    kind = "cls bigint, members bigint, group bigint, size int, vector array<double>"
    placed = classes.select("cls", "members", "group", "size", "vector").mapInArrow(
        _cells(axes, eps), f"{kind}, cells array<int>"
    )
    ordered = placed.repartitionByRange("group", "cells", "cls").sortWithinPartitions("group", "cells", "cls")
    blocks = stage(
        ordered.drop("cells").mapInArrow(
            _blocks(axes, block_rows),
            "group bigint, size int, block bigint, low array<double>, high array<double>, cls binary, members binary, "
            "vectors binary",
        ),
        "blocks",
    )
    outline = blocks.select("group", "block", "low", "high")
    first = F.floor(F.element_at("low", 1) / eps).cast("int"), F.floor(F.element_at("high", 1) / eps).cast("int")
    a = outline.select(
        F.explode(F.sequence(*first)).alias("a_cell"), *[F.col(c).alias(f"a_{c}") for c in outline.columns]
    )
    b = outline.select(
        F.explode(F.sequence(first[0] - 1, first[1] + 1)).alias("b_cell"),
        *[F.col(c).alias(f"b_{c}") for c in outline.columns],
    )
    gaps = F.zip_with(
        F.arrays_zip("a_low", "a_high"), F.arrays_zip("b_low", "b_high"),
        lambda x, y: F.greatest(F.lit(0.0), x["a_low"] - y["b_high"], y["b_low"] - x["a_high"]),
    )
    near = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= eps * eps + 1e-9
    meet = (F.col("a_group") == F.col("b_group")) & (F.col("a_cell") == F.col("b_cell"))
    meet &= F.col("a_block") <= F.col("b_block")
    pairs = a.join(b, meet & near).select("a_block", "b_block").distinct()

    def side(name: str) -> DataFrame:
        return blocks.select(*[F.col(c).alias(f"{name}_{c}") for c in ("block", "size", "cls", "members", "vectors")])

    both = pairs.join(side("a"), "a_block").join(side("b"), "b_block")
    found = stage(
        both.mapInArrow(_join(axes, threshold, eps), "cls bigint, linked bigint, other bigint"), "found"
    )
    result = resolve(classes.select("cls", "class_id", "members"), found)
    linked = join_crowded(rows.select("vec_id", "cls"), result, "cls", "members")
    lone = rows.filter("cls is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (
        linked.select("vec_id", "n_links", "component_id")
        .unionByName(lone)
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
