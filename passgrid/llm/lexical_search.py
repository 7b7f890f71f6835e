"""Ranked lexical search over blocks of similar documents.

1. One pass over the texts counts words: per document its length and the frequencies of the words that the queries use.
   Counts for the weights (documents, words, documents per term) come from that table.
2. Documents are put in order of similarity: each goes to the nearest of 64 centers in a space of 32 random projections
   of its term weights, and the documents of a center are dealt out by range, so a large center fills many tasks.
3. A task takes its documents in chunks. In a chunk each term has a posting list, and the list is cut into geometric
   blocks: pivots are taken from the list itself and each document joins its most similar pivot. A block stores as its
   summary the largest impact of every term in any of its documents.
4. A query's score for no document of a block can exceed the weighted sum of the summary. Only blocks whose sum
   falls below the score of the 50th document found so far are skipped; so are whole lists that, together, can't lift a
   document to that score. Documents of all other blocks are scored exactly. All values are integers, so bounds are exact
   and equal scores are never skipped.

The first 50th scores are those of a sample of documents, which are documents like any other, hence never too high. A task
returns its best 50 documents of each query at most; they are merged in two steps, so that no query's rows meet in one
task until few are left. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passgrid.llm.columns import quoted
from passgrid.llm.words import mix, slices
from passgrid.session import stage

TOP = 50
CENTERS, DIMENSIONS = 64, 32
SAMPLE_DOCS = 8_192
# Terms of the queries searched for in one pass, terms of one batch within a chunk, cells of a chunk's dense tables.
PASS_TERMS, BATCH_TERMS, CELLS = 1 << 18, 4096, 1 << 22
TASK_POSTINGS = 1 << 20
BLOCK_DOCS, LARGEST_BLOCK = 32, 64
_SCALE = 1_000_000

FORWARD = "_id bigint, n bigint, terms array<int>, counts array<int>"
FOUND = "_item bigint, doc_id bigint, score bigint"


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each item's different terms as hashes."""
    for batch in batches:
        for words in slices(batch.column("_text")):
            rows = batch.slice(words.first, len(words.bounds) - 1)
            terms = [
                np.unique(words.hashes[a:b]).view(np.int64).tolist() for a, b in zip(words.bounds[:-1], words.bounds[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [rows.column("_item"), rows.column("item_id"), pa.array(terms, pa.list_(pa.int64()))],
                ["_item", "item_id", "terms"],
            )


def _count_terms(vocabulary: Broadcast):
    """Per text with a word: its length, and which terms of the vocabulary it holds how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            for words in slices(batch.column("_text")):
                size = len(words.bounds) - 1
                ids = batch.column("_id").slice(words.first, size)
                at = np.minimum(np.searchsorted(known, words.hashes), max(len(known) - 1, 0))
                hit = known[at] == words.hashes if len(known) else np.zeros(len(at), bool)
                keys, times = np.unique(words.text_of()[hit] * max(len(known), 1) + at[hit], return_counts=True)
                text, term = np.divmod(keys, max(len(known), 1))
                bounds = np.searchsorted(text, np.arange(size + 1))
                made = pa.RecordBatch.from_arrays(
                    [ids, pa.array(words.counts, pa.int64()), _lists(term, bounds), _lists(times, bounds)],
                    ["_id", "n", "terms", "counts"],
                )
                yield made.filter(pa.array(words.counts > 0))

    return run


@dataclass
class Weights:
    """Counts of all documents and what follows from them for each term of the vocabulary."""

    docs: int
    words: int
    weight: np.ndarray
    direction: np.ndarray

    @staticmethod
    def of(docs: int, words: int, holders: np.ndarray, vocabulary: np.ndarray) -> Weights:
        weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1))) for df in holders.tolist()], np.int64)
        bits = mix(vocabulary[:, None] ^ mix(np.arange(1, DIMENSIONS + 1, dtype=np.uint64))[None, :])
        return Weights(docs, words, weight, np.where(bits >> np.uint64(63), 1.0, -1.0).astype(np.float32))

    def impacts(self, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """A term's impact in a document of ``n`` words that holds it ``counts`` times."""
        if int(n.max(initial=0)) * 50 * self.docs < 1 << 62:
            length = 50 + (50 * n * self.docs) // self.words
        else:
            length = np.array([50 + 50 * x * self.docs // self.words for x in n.tolist()], np.int64)
        return (1_000_000_000 * counts) // (1000 * counts + 20 * length)

    def projections(self, terms: np.ndarray, impacts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Each document's weighted terms in few dimensions, of length 1; zero without terms."""
        out = np.zeros((len(bounds) - 1, DIMENSIONS), np.float32)
        full = np.flatnonzero(np.diff(bounds))
        if len(full):
            values = (self.weight[terms] * impacts / 1e9).astype(np.float32)
            out[full] = np.add.reduceat(self.direction[terms] * values[:, None], bounds[full], axis=0)
        size = np.sqrt((out * out).sum(1, keepdims=True))
        return out / np.where(size > 0, size, 1)


@dataclass
class Docs:
    """Documents with their terms of the vocabulary, those of document ``i`` at ``bounds[i]:bounds[i + 1]``."""

    ids: np.ndarray
    no_id: np.ndarray
    terms: np.ndarray
    impacts: np.ndarray
    bounds: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch | pa.Table, weights: Weights) -> Docs:
        if isinstance(batch, pa.Table):
            batch = batch.combine_chunks()
        column = lambda c: x.combine_chunks() if isinstance(x := batch.column(c), pa.ChunkedArray) else x
        terms, counts = column("terms"), column("counts")
        bounds = np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))])
        n = np.repeat(column("n").to_numpy(zero_copy_only=False).astype(np.int64), np.diff(bounds))
        counts = counts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ids = column("_id")
        return Docs(
            ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
            ids.is_null().to_numpy(zero_copy_only=False),
            terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64), weights.impacts(n, counts), bounds,
        )

    def __len__(self) -> int:
        return len(self.ids)

    def part(self, a: int, b: int) -> Docs:
        at, to = self.bounds[a], self.bounds[b]
        return Docs(self.ids[a:b], self.no_id[a:b], self.terms[at:to], self.impacts[at:to], self.bounds[a : b + 1] - at)


class Best:
    """The best documents of one query so far: by score, then by id, those without one last. ``least`` is the score
    that a document must reach to matter."""

    def __init__(self, least: int, top: int):
        self.least, self.top = least, top
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.no_id = np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        good = scores >= self.least
        if not good.any():
            return
        self.scores = np.concatenate([self.scores, scores[good]])
        self.ids, self.no_id = np.concatenate([self.ids, ids[good]]), np.concatenate([self.no_id, no_id[good]])
        if len(self.scores) >= self.top:
            first = np.lexsort((self.ids, self.no_id, -self.scores))[: self.top]
            self.scores, self.ids, self.no_id = self.scores[first], self.ids[first], self.no_id[first]
            self.least = max(self.least, int(self.scores[-1]))


@dataclass
class Batch:
    """Some queries, the terms that they use, and the weight of each term (row) in each query (column)."""

    queries: list[int]
    vocabulary: np.ndarray
    places: list[np.ndarray]
    weights: np.ndarray


def batches_of(queries: list[np.ndarray], weight: np.ndarray) -> list[Batch]:
    """Queries packed so that neither their terms nor the table of weights grow large; one alone may be any size.
    Terms without weight are left out, and so are queries without any other."""
    groups: list[tuple[list[int], set[int]]] = []
    for q in sorted(range(len(queries)), key=lambda q: len(queries[q])):
        own = {t for t in queries[q].tolist() if weight[t] > 0}
        if not own:
            continue
        if groups:
            members, terms = groups[-1]
            more = terms | own
            if len(more) <= BATCH_TERMS and len(more) * (len(members) + 1) <= CELLS:
                members.append(q)
                terms |= own
                continue
        groups.append(([q], set(own)))
    out = []
    for members, terms in groups:
        vocabulary = np.array(sorted(terms), np.int64)
        places = [np.searchsorted(vocabulary, [t for t in queries[q].tolist() if weight[t] > 0]) for q in members]
        table = np.zeros((len(vocabulary), len(members)))
        for i, own in enumerate(places):
            table[own, i] = weight[vocabulary[own]]
        out.append(Batch(members, vocabulary, places, table))
    return out


def _dense(docs: Docs, vocabulary: np.ndarray) -> np.ndarray:
    """Impacts of a batch's terms, a row per document. Doubles hold all sums of weighted impacts exactly."""
    at = np.minimum(np.searchsorted(vocabulary, docs.terms), len(vocabulary) - 1)
    hit = vocabulary[at] == docs.terms
    out = np.zeros((len(docs), len(vocabulary)))
    out[np.repeat(np.arange(len(docs)), np.diff(docs.bounds))[hit], at[hit]] = docs.impacts[hit]
    return out


def blocks_of(rows: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A posting list in blocks of similar documents: the rows block by block, and where blocks start. Pivots are taken
    evenly from the list; a block of more than 64 documents is cut."""
    pivots = -(-len(rows) // BLOCK_DOCS)
    if pivots == 1:
        return rows, np.zeros(1, np.int64)
    at = np.arange(pivots) * len(rows) // pivots
    nearest = (positions[rows] @ positions[rows[at]].T).argmax(1)
    order = np.argsort(nearest, kind="stable")
    begin = np.flatnonzero(np.diff(nearest[order], prepend=-1))
    inside = np.arange(len(rows)) - np.repeat(begin, np.diff(np.append(begin, len(rows))))
    return rows[order], np.flatnonzero(inside % LARGEST_BLOCK == 0)


def needed_terms(most: np.ndarray, least: int) -> np.ndarray:
    """Which terms' lists a document must be in to reach ``least``, if it can't gain more than ``most`` from each: all
    but those that together stay below."""
    order = np.argsort(most, kind="stable")
    return order[np.cumsum(most[order]) >= least]


def search_chunk(docs: Docs, weights: Weights, batch: Batch, best: list[Best]) -> int:
    """Add a chunk's documents to the queries' best; how many documents were scored."""
    impacts = _dense(docs, batch.vocabulary)
    positions = weights.projections(docs.terms, docs.impacts, docs.bounds)
    top = impacts.max(axis=0, initial=0.0)
    wanted: dict[int, list[int]] = {}
    for i, (q, places) in enumerate(zip(batch.queries, batch.places)):
        most = top[places] * batch.weights[places, i]
        for t in places[needed_terms(most, best[q].least)].tolist():
            if top[t]:
                wanted.setdefault(t, []).append(i)
    seen = np.zeros((len(batch.queries), len(docs)), bool)
    scored = 0
    # Lists of heavy terms first: they lift the scores to be reached.
    for t in sorted(wanted, key=lambda t: (-weights.weight[batch.vocabulary[t]], t)):
        rows, starts = blocks_of(np.flatnonzero(impacts[:, t]), positions)
        summaries = np.maximum.reduceat(impacts[rows], starts, axis=0)
        bounds = summaries @ batch.weights[:, wanted[t]]
        ends = np.append(starts[1:], len(rows))
        for j, i in enumerate(wanted[t]):
            own, q, places = bounds[:, j], batch.queries[i], batch.places[i]
            order = np.argsort(-own, kind="stable")
            # The most promising block alone, then all others that still can matter.
            for some in (order[:1], order[1:]):
                some = some[own[some] >= best[q].least]
                if not len(some):
                    continue
                at = np.concatenate([rows[starts[k] : ends[k]] for k in some])
                at = at[~seen[i, at]]
                seen[i, at] = True
                scored += len(at)
                scores = (impacts[np.ix_(at, places)] @ batch.weights[places, i]).astype(np.int64)
                best[q].add(scores, docs.ids[at], docs.no_id[at])
    return scored


@dataclass
class Search:
    weights: Weights
    items: np.ndarray
    batches: list[Batch]
    least: list[int]
    top: int


def _search(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search: Search = shared.value
        best = [Best(least, search.top) for least in search.least]
        for docs in _chunks(batches, search):
            for batch in search.batches:
                size = max(64, CELLS // len(batch.vocabulary))
                for at in range(0, len(docs), size):
                    search_chunk(docs.part(at, min(at + size, len(docs))), search.weights, batch, best)
        for q, own in enumerate(best):
            if len(own.scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(own.scores), search.items[q]), pa.int64()),
                        pa.array(own.ids, pa.int64(), mask=own.no_id),
                        pa.array(own.scores, pa.int64()),
                    ],
                    ["_item", "doc_id", "score"],
                )

    return run


def _chunks(batches: Iterator[pa.RecordBatch], search: Search) -> Iterator[Docs]:
    """Rows gathered to some 200,000 postings, so that lists are long enough to be cut into blocks."""
    held: list[pa.RecordBatch] = []
    postings = 0
    for batch in batches:
        held.append(batch)
        postings += len(batch.column("terms").flatten())
        if postings >= TASK_POSTINGS // 4:
            yield Docs.of(pa.Table.from_batches(held), search.weights)
            held, postings = [], 0
    if held:
        yield Docs.of(pa.Table.from_batches(held), search.weights)


def _centers(positions: np.ndarray) -> np.ndarray:
    """Directions around which the sample gathers: k-means on the unit sphere, started at evenly spaced documents."""
    if not len(positions):
        return np.zeros((1, DIMENSIONS), np.float32)
    centers = positions[np.arange(min(CENTERS, len(positions))) * len(positions) // min(CENTERS, len(positions))].copy()
    for _ in range(5):
        nearest = (positions @ centers.T).argmax(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, positions)
        size = np.sqrt((sums * sums).sum(1, keepdims=True))
        centers = np.where(size > 0, sums / np.where(size > 0, size, 1), centers)
    return centers


def _place(weights: Broadcast, centers: np.ndarray):
    """Adds each document's center and how near it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = Docs.of(batch, weights.value)
            likeness = weights.value.projections(docs.terms, docs.impacts, docs.bounds) @ centers.T
            added = [pa.array(likeness.argmax(1).astype(np.int32)), pa.array(likeness.max(1).astype(np.float32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "center", "likeness"])

    return run


def _first_least(sample: Docs, search_batches: list[Batch], queries: int, top: int) -> list[int]:
    """For each query the score of the sample's ``top``-th document, or 1 where fewer score."""
    least = [1] * queries
    for batch in search_batches:
        scores = []
        size = max(64, CELLS // len(batch.vocabulary))
        for at in range(0, len(sample), size):
            found = _dense(sample.part(at, min(at + size, len(sample))), batch.vocabulary) @ batch.weights
            scores.append(np.sort(found, axis=0)[-top:])
        if scores:
            ranked = np.sort(np.concatenate(scores), axis=0)[::-1]
            for i, q in enumerate(batch.queries):
                if len(ranked) >= top:
                    least[q] = max(1, int(ranked[top - 1, i]))
    return least


def _best_rows(found: DataFrame, top: int, tasks: int) -> DataFrame:
    """The first rows of each item, ranked. Rows are thinned out by item and a share of the tasks first."""
    shares = math.isqrt(tasks)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    dealt = found.withColumn("_share", F.pmod(F.spark_partition_id(), F.lit(shares)))
    few = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("_item", "_share").orderBy(*order)))
    few = few.filter(F.col("_rank") <= top).drop("_rank", "_share")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("_item").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top)


def _search_pass(texts: DataFrame, items: DataFrame, top: int) -> DataFrame:
    """Rank all documents for items whose terms fit one pass."""
    spark = texts.sparkSession
    asked = items.select("_item", "terms").orderBy("_item").toArrow().combine_chunks()
    hashes = asked.column("terms").combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    vocabulary = np.unique(hashes)
    lengths = [len(x) for x in asked.column("terms")]
    queries = np.split(np.searchsorted(vocabulary, hashes), np.cumsum(lengths)[:-1]) if lengths else []
    shared = spark.sparkContext.broadcast(vocabulary)
    forward = stage(texts.mapInArrow(_count_terms(shared), FORWARD), "forward")
    total = forward.agg(F.count("*"), F.sum("n"), F.sum(F.size("terms"))).first()
    if not total[0] or not len(vocabulary):
        return spark.createDataFrame([], FOUND).withColumn("rank", F.lit(None).cast("int"))
    holders = np.zeros(len(vocabulary), np.int64)
    counted = forward.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    holders[counted["term"].to_numpy()] = counted["count"].to_numpy()
    weights = Weights.of(total[0], total[1], holders, vocabulary)
    batches = batches_of(queries, weights.weight)

    used = forward.filter(F.size("terms") > 0)
    share = min(_SCALE, int(_SCALE * SAMPLE_DOCS / total[0]) + 1)
    drawn = used.filter(F.pmod(F.xxhash64("_id", "terms", "counts"), F.lit(_SCALE)) < share).limit(2 * SAMPLE_DOCS)
    sample = Docs.of(drawn.toArrow(), weights)
    centers = _centers(weights.projections(sample.terms, sample.impacts, sample.bounds))
    search = Search(
        weights, asked.column("_item").to_numpy(), batches, _first_least(sample, batches, len(queries), top), top
    )
    placed = used.mapInArrow(
        _place(spark.sparkContext.broadcast(weights), centers), f"{FORWARD}, center int, likeness float"
    )
    tasks = max(1, -(-int(total[2]) // TASK_POSTINGS))
    dealt = placed.repartitionByRange(tasks, "center", "likeness", F.xxhash64("_id")).sortWithinPartitions("center", "likeness")
    found = dealt.select("_id", "n", "terms", "counts").mapInArrow(_search(spark.sparkContext.broadcast(search)), FOUND)
    return _best_rows(stage(found, "found"), top, tasks)


def search_documents(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items`` its ``top`` best documents with a score above 0.

    Terms are runs of letters a-z, digits and characters beyond ASCII after A-Z became a-z. A term weighs
    ``floor(1000 * ln((2N + 2) / (2df + 1)))``; a document adds ``weight * (1000000000 tf div (1000 tf + 20 m))`` for each
    different term of the item, with ``m = 50 + 50 n N div L``. Equal scores rank by ascending id, rows without an id last.

    Document ids must be integers; equal ids on several rows are several documents. Each item row is ranked by itself, also
    if another has its id or text. Null, empty and wordless texts count as no documents and, as items, find nothing; so
    does an empty table.
    """
    spark = docs.sparkSession
    texts = docs.select(quoted(id_col).cast("bigint").alias("_id"), quoted(text_col).cast("string").alias("_text"))
    named = items.select(
        F.monotonically_increasing_id().alias("_item"), quoted(item_col).alias("item_id"),
        quoted(item_text_col).cast("string").alias("_text"),
    )
    kind = T.StructType([*named.select("_item", "item_id").schema.fields, T.StructField("terms", T.ArrayType(T.LongType()))])
    asked = stage(named.mapInArrow(_distinct_terms, kind).filter(F.size("terms") > 0), "items")
    terms = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    passes = max(1, -(-terms // PASS_TERMS))
    found = None
    for k in range(passes):
        own = asked.filter(F.pmod(F.xxhash64("_item"), F.lit(passes)) == k)
        ranked = _search_pass(texts, own, top).join(F.broadcast(own.select("_item", "item_id")), "_item")
        found = ranked if found is None else found.unionByName(ranked)
    return found.select("item_id", "rank", "doc_id", "score")
