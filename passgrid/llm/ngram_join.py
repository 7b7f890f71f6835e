"""Near duplicates by word n-grams: MinHash values compared step by step with a Bayesian stop, the rest exactly.

1. Texts with the same sequence of words form a class; classes are compared, not copies.
2. Classes that agree in one of 32 bands of four MinHash values are candidates. Bands are shuffled once, into ranges of
   band and class, so that a crowded band is spread; neighbours of one band are linked. The links' connected components
   are the candidate groups, so every candidate pair lies inside a group.
3. Inside a group, pairs are compared on 128 MinHash values, sixteen at a time. With m of n equal, the similarity has
   the posterior Beta(m + 1, n - m + 1); a pair goes once its probability of reaching the threshold falls below the
   tolerance. The remaining pairs are verified on their shingle sets.
4. Verified links are counted per class, weighted by the copies on the other side; only a spanning forest leaves a
   task, never all pairs. A group too large for one task is dealt into chunks, and each pair of chunks is a task.

A pair at the threshold shares no band with probability (1 - 0.8 ** 4) ** 32 < 5e-8 and is stopped early with less than
the tolerance of 1e-6 per step. A chained candidate group of n classes costs n * n / 2 comparisons of sixteen values.
Classes and shingles are identified by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passgrid.llm.columns import fresh, quoted, without
from passgrid.llm.links import components, join_crowded, resolve
from passgrid.llm.prefilter import likely_in
from passgrid.llm.words import WORD_CHARACTER, mix, slices
from passgrid.session import stage

SHINGLE_WORDS = 5
THRESHOLD = 0.8
HASHES, BANDS, STEP = 128, 32, 16
TOLERANCE = 1e-6
CHUNK_CLASSES, CHUNK_WORDS, PACK_WORDS = 1024, 2_000_000, 500_000

_SEEDS = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_FLIP = (_SEEDS[:HASHES] >> np.uint64(32)).astype(np.uint32)
_FACTOR = (_SEEDS[HASHES:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def signatures(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values, one row per text; texts without shingles get the largest value everywhere."""
    out = np.full((len(bounds) - 1, HASHES), 0xFFFFFFFF, np.uint32)
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled):
        low = (shingles >> np.uint64(32)).astype(np.uint32)
        for k in range(HASHES):
            out[filled, k] = np.minimum.reduceat((low ^ _FLIP[k]) * _FACTOR[k], bounds[filled])
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A key per band, different bands never alike."""
    rows = signature.reshape(len(signature), BANDS, HASHES // BANDS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), rows.shape[:2])
    for k in range(rows.shape[2]):
        keys = mix(keys ^ rows[:, :, k]) + np.uint64(k)
    return keys.view(np.int64)


def least_matches(threshold: float, tolerance: float = TOLERANCE) -> np.ndarray:
    """For each step, the fewest equal values with which a pair goes on."""
    need = []
    for n in range(STEP, HASHES + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance:  # P(similarity >= threshold) = P(Binomial(n + 1, threshold) <= m)
            m += 1
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        need.append(m)
    return np.array(need)


def _classes(text: str, keep: list[str], with_bands: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``cls`` (null for a text without words), and ``n_words`` and ``bands`` on request, to the columns kept; the
    bands of a class leave a task once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            kept = batch.select(keep)
            for words in slices(batch.column(text)):
                n = words.counts
                cls = words.fingerprints().view(np.int64)
                more = [pa.array(cls, mask=n == 0)]
                if with_bands:
                    new = [i for i, c in enumerate(cls.tolist()) if n[i] and c not in seen and not seen.add(c)]
                    if len(seen) > 1_000_000:
                        seen.clear()
                    shingles, bounds = words.shingles(SHINGLE_WORDS)
                    keys = band_keys(signatures(shingles, bounds)[new])
                    offsets = np.zeros(len(n) + 1, np.int32)
                    offsets[np.array(new, np.int64) + 1] = BANDS
                    more.append(pa.array(n.astype(np.int64)))
                    more.append(pa.ListArray.from_arrays(np.cumsum(offsets, dtype=np.int32), keys.ravel()))
                part = kept.slice(words.first, len(n))
                names = ["cls", "n_words", "bands"][: len(more)]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*keep, *names])

    return run


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links ``band, a, b`` between neighbours of one band in sorted rows; the partition's first and last row come as
    links of a class with itself."""

    def links(band: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"band": band, "a": a, "b": b})

    last = None
    for batch in batches:
        band, cls = batch.column("band").to_numpy(), batch.column("cls").to_numpy()
        if not len(band):
            continue
        if last is None:
            yield links(band[:1], cls[:1], cls[:1])
        else:
            band, cls = np.concatenate([last[0], band]), np.concatenate([last[1], cls])
        meet = np.flatnonzero((band[1:] == band[:-1]) & (cls[1:] != cls[:-1]))
        yield links(band[meet], cls[meet], cls[meet + 1])
        last = band[-1:], cls[-1:]
    if last is not None:
        yield links(last[0], last[1], last[1])


def _met(keyed: DataFrame) -> DataFrame:
    """Links ``a, b`` that connect all classes of each band."""
    ordered = keyed.repartitionByRange("band", "cls").sortWithinPartitions("band", "cls")
    found = stage(ordered.mapInArrow(_chains, "band bigint, a bigint, b bigint"), "bands")
    # Ranges that share a band are linked at their ends, two rows a range.
    ends = found.filter("a = b")
    across = ends.join(F.broadcast(ends.groupBy("band").agg(F.min("a").alias("least"))), "band")
    return found.filter("a != b").select("a", "b").unionByName(
        across.select("a", F.col("least").alias("b")).filter("a != b")
    )


def _links(rows: list[int], others: list[int] | None, sig, sets, weights, need, threshold):
    """Links between ``rows``, or from ``rows`` to ``others``: weight linked to each text, and a parent of each."""
    everyone = rows if others is None else [*rows, *others]
    parent = {i: i for i in everyone}
    linked = dict.fromkeys(everyone, 0)

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    terms, at = np.unique(np.concatenate([sets[i] for i in everyone]), return_inverse=True)
    sizes = np.array([len(sets[i]) for i in everyone])
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    members, sigs = np.array(everyone), sig[everyone]
    mark = np.zeros(len(terms), bool)
    for i in range(len(rows)):
        alive = np.arange(i + 1 if others is None else len(rows), len(everyone))
        # A set can't reach the threshold with one too much smaller.
        alive = alive[np.minimum(sizes[alive], sizes[i]) >= threshold * np.maximum(sizes[alive], sizes[i]) - 1e-9]
        equal = np.zeros(len(alive), np.int64)
        for step, least in enumerate(need):
            if not len(alive):
                break
            part = slice(step * STEP, (step + 1) * STEP)
            equal += (sigs[alive, part] == sigs[i, part]).sum(1)
            on = equal >= least
            alive, equal = alive[on], equal[on]
        if not len(alive):
            continue
        own = at[begins[i] : begins[i] + sizes[i]]
        mark[own] = True
        if len(alive) * 4 > len(everyone):
            common = np.add.reduceat(mark[at].astype(np.int64), begins)[alive]
        else:
            common = np.array([np.count_nonzero(mark[at[begins[j] : begins[j] + sizes[j]]]) for j in alive])
        mark[own] = False
        for j in alive[common >= threshold * (sizes[i] + sizes[alive] - common) - 1e-9]:
            x, y = members[i], members[j]
            linked[x] += weights[y]
            linked[y] += weights[x]
            x, y = top(x), top(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    return [(i, linked[i], top(i)) for i in everyone if linked[i]]


def _verify(threshold: float, need: np.ndarray) -> Callable[[tuple, pa.Table], pa.Table]:
    def run(key: tuple, group: pa.Table) -> pa.Table:
        across = key[1].as_py() != key[2].as_py()
        out = []
        cls = group["cls"].to_numpy()
        weights = group["members"].to_pylist()
        sig, sets = [], []
        for words in slices(group["_text"]):
            shingles, bounds = words.shingles(SHINGLE_WORDS)
            sig.append(signatures(shingles, bounds))
            sets += [np.unique(shingles[a:b]) for a, b in zip(bounds, bounds[1:])]
        sig = np.concatenate(sig)
        roots, chunks = group["root"].to_numpy(), group["chunk"].to_numpy()
        order = np.argsort(roots, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(roots[order])) + 1):
            if across:
                left = rows[chunks[rows] == key[1].as_py()].tolist()
                right = rows[chunks[rows] != key[1].as_py()].tolist()
                if left and right:
                    out += _links(left, right, sig, sets, weights, need, threshold)
            elif len(rows) > 1:
                out += _links(rows.tolist(), None, sig, sets, weights, need, threshold)
        a, links, b = np.array(out, np.int64).reshape(-1, 3).T
        return pa.table({"cls": cls[a], "linked": links, "other": cls[b]})

    return run


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``cls, doc_id, class_id, n_links, component_id, kept`` of every document.

    Two documents are linked if the sets of their runs of five words have a Jaccard similarity of ``threshold`` (0.8)
    or more. ``class_id`` is the smallest id with the same words, ``n_links`` the documents linked directly, copies
    included, ``component_id`` the smallest id reachable, ``kept`` whether the row has that id.

    Words as in :mod:`passgrid.llm.words`. Fewer than five words are one shingle. A null, empty or wordless text links
    with nothing, is its own component and is kept; its ``cls`` is null. Repeated rows count as copies. Among ids, null
    is never the smallest unless all are null. Ids must be integers. Other columns are ignored.
    """
    narrow = docs.select(quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).cast("string").alias("_text"))
    schema = "doc_id bigint, cls bigint, n_words bigint, bands array<bigint>"
    rows = stage(narrow.mapInArrow(_classes("_text", ["doc_id"], True), schema), "classes")
    keyed = rows.filter("size(bands) > 0").select(F.explode("bands").alias("band"), "cls")
    groups = components(_met(keyed), "a", "b")

    classes = stage(
        rows.filter("cls is not null")
        .groupBy("cls")
        .agg(F.min("doc_id").alias("class_id"), F.count("*").alias("members"), F.max("n_words").alias("n_words")),
        "classes",
    )
    nodes = classes.join(groups.withColumnRenamed("node", "cls"), "cls")
    nodes = stage(nodes, "nodes")
    sizes = nodes.groupBy("root").agg(
        F.count("*").alias("_n"),
        F.greatest(F.ceil(F.count("*") / CHUNK_CLASSES), F.ceil(F.sum("n_words") / CHUNK_WORDS)).cast("int").alias("m"),
        F.sum("n_words").alias("group_words"),
    )
    nodes = stage(join_crowded(nodes, stage(sizes, "sizes"), "root", "_n"), "groups")
    words = nodes.filter("m = 1").agg(F.sum("n_words")).first()[0] or 0
    packs = max(12, -(-words // PACK_WORDS))

    named = narrow.mapInArrow(_classes("_text", ["doc_id", "_text"], False), "doc_id bigint, _text string, cls bigint")
    # Most texts meet nobody; they aren't shuffled for the join.
    chosen = (
        likely_in(named, "cls", nodes, "cls").join(nodes, "cls").filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).dropDuplicates(["cls"])
    )
    chunk = F.pmod(F.xxhash64("cls"), F.col("m")).cast("int")
    tasks = (
        chosen.select("cls", "root", "members", "_text", "m", chunk.alias("chunk"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
        .withColumn("lo", F.least("chunk", "_other"))
        .withColumn("hi", F.greatest("chunk", "_other"))
        .withColumn("pack", F.when(F.col("m") > 1, F.col("root")).otherwise(F.pmod(F.xxhash64("root"), F.lit(packs))))
        .withColumn("many", F.col("m") > 1)
        .drop("_other", "m")
    )
    verify = _verify(threshold, least_matches(threshold))
    found = stage(
        tasks.groupBy("pack", "lo", "hi", "many").applyInArrow(verify, "cls bigint, linked bigint, other bigint"),
        "found",
    )
    result = resolve(classes, found)
    linked = join_crowded(rows.select("doc_id", "cls"), result, "cls", "members")
    lone = rows.filter("cls is null").select(
        "cls", "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"),
        F.col("doc_id").alias("component_id"),
    )
    return (
        linked.select("cls", "doc_id", "class_id", "n_links", "component_id")
        .unionByName(lone)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def drop_near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The documents with one of each component: all columns of the row with its smallest id, one row of repeated ones.

    Wordless documents stay. The texts are shuffled once, by class.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, threshold=threshold)
    keepers = found.filter("kept and cls is not null").select("cls", F.col("doc_id").alias("_keep")).distinct()
    cls, keep, rank, text = fresh(docs, "cls", "_keep", "_rank", "_text")
    keepers = stage(keepers, "keep").select(F.col("cls").alias(cls), F.col("_keep").alias(keep))

    def with_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [pa.array(w.fingerprints().view(np.int64), mask=w.counts == 0) for w in slices(batch.column(text))]
            column = pa.concat_arrays(ids) if ids else pa.array([], pa.int64())
            rest = batch.select([c for c in batch.schema.names if c != text])
            yield pa.RecordBatch.from_arrays([*rest.columns, column], [*rest.schema.names, cls])

    schema = T.StructType([*docs.schema.fields, T.StructField(cls, T.LongType())])
    marked = docs.withColumn(text, quoted(text_col).cast("string")).mapInArrow(with_class, schema)
    wordless = ~F.coalesce(quoted(text_col).cast("string"), F.lit("")).rlike(WORD_CHARACTER)
    same = quoted(id_col).cast("bigint").eqNullSafe(quoted(keep))
    one = (
        marked.join(keepers, cls)
        .filter(same)
        .withColumn(rank, F.row_number().over(Window.partitionBy(cls, quoted(id_col)).orderBy(F.lit(0))))
        .filter(quoted(rank) == 1)
    )
    columns = without(docs, [])
    return one.select(*columns).unionByName(docs.filter(wordless))
