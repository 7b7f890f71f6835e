import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from passgrid.llm import lexical_search as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")]


def plain(docs, items, top=50):
    bags = [(i, Counter(words_of(t))) for i, t in docs]
    bags = [(i, bag, sum(bag.values())) for i, bag in bags if bag]
    n, total = len(bags), sum(size for *_, size in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        scores = []
        for i, bag, size in bags:
            m = 100 - 50 + (50 * size * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 20 * m))
                for t in set(words_of(text)) if bag[t]
            )
            if score > 0:
                scores.append((-score, i is None, i or 0))
        scores.sort()
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(scores[:top], 1)]
    return sorted(map(repr, out))


def found(spark, docs, items, **kind):
    got = ls.search_documents(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string"), **kind)
    return sorted(repr((r["item_id"], r["rank"], r["doc_id"], r["score"])) for r in got.collect())


def corpus(n, seed=4):
    """Topics with words of their own, common words, copies, and a third of all rows alike."""
    rng = random.Random(seed)
    topics = [[f"w{t}x{k}" for k in range(12)] for t in range(15)]
    common = ["the", "An", "of", "É", "字"]
    docs = []
    for i in range(n):
        own = rng.choice(topics) + common + [f"r{rng.randrange(400)}"]
        docs.append((i, " ".join(rng.choice(own) for _ in range(rng.choice([3, 20, 60, 200])))))
    docs += [(n + i, "the same TEXT of w3x1 w3x2 an") for i in range(n // 2)]
    items = [(k, " ".join(rng.choice(rng.choice(topics) + common) for _ in range(rng.choice([1, 5, 25])))) for k in range(40)]
    return docs, items


def test_agrees_with_scoring_every_document(spark):
    docs, items = corpus(900)
    docs += [(5, docs[5][1]), (5, "w1x1 w1x1"), (None, "w1x1 w2x2"), (None, None), (9999, ""), (9998, "... !!")]
    items += [(7, items[7][1]), (7, "text same"), (None, "same"), (100, None), (101, ""), (102, "unknown"), (103, "The tHE")]
    assert found(spark, docs, items) == plain(docs, items)
    assert found(spark, docs, items, top=3) == plain(docs, items, top=3)


def test_many_passes_and_batches(spark, monkeypatch):
    docs, items = corpus(300, seed=8)
    want = plain(docs, items, top=10)
    for name, value in (("PASS_TERMS", 60), ("BATCH_TERMS", 20), ("CELLS", 1200), ("TASK_POSTINGS", 2000), ("SAMPLE_DOCS", 20)):
        monkeypatch.setattr(ls, name, value)
    assert found(spark, docs, items, top=10) == want


def test_empty_tables(spark):
    docs, items = corpus(20)
    assert found(spark, [], items) == [] and found(spark, docs, []) == []
    assert found(spark, [(1, None)], items) == []


def test_long_texts(spark):
    docs = [(1, "word " * 200_000 + "rare"), (2, "rare word"), (3, "x" * 300_000), (4, "other")]
    items = [(1, "rare"), (2, "x" * 300_000 + " other")]
    assert found(spark, docs, items) == plain(docs, items)


@pytest.mark.parametrize("seed", range(4))
def test_summaries_bound_scores_and_skip_documents(seed):
    rng = np.random.default_rng(seed)
    terms, docs, topics = 120, 2000, 12
    vocabulary = np.arange(1, terms + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rows = []
    for i in range(docs):
        topic = rng.integers(topics)
        own = np.unique(np.concatenate([rng.integers(0, 10, 3), 10 + topic * 9 + rng.integers(0, 9, 6)]))
        rows.append(own)
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    flat = np.concatenate(rows)
    weights = ls.Weights.of(docs, docs * 50, np.bincount(flat, minlength=terms), vocabulary)
    impacts = weights.impacts(np.full(len(flat), 50), rng.integers(1, 5, len(flat)))
    order = np.argsort(weights.projections(flat, impacts, bounds)[:, 0], kind="stable")
    made = ls.Docs(np.arange(docs), np.zeros(docs, bool), flat, impacts, bounds)
    queries = [np.unique(rng.integers(0, terms, 8)) for _ in range(10)]
    (batch,) = ls.batches_of(queries, weights.weight)
    best = [ls.Best(1, 10) for _ in queries]
    scored = ls.search_chunk(made, weights, batch, best)
    dense = ls._dense(made, batch.vocabulary)
    for i, q in enumerate(batch.queries):
        scores = (dense @ batch.weights)[:, i].astype(int)
        want = sorted(zip(-scores, range(docs)))[:10]
        assert list(zip((-best[q].scores).tolist(), best[q].ids.tolist())) == [(int(a), b) for a, b in want if a < 0]
    assert scored < 0.8 * docs * len(queries)
    positions = weights.projections(flat, impacts, bounds)
    listed, starts = ls.blocks_of(order[:700], positions)
    assert sorted(listed.tolist()) == sorted(order[:700].tolist())
    assert np.diff(np.append(starts, 700)).max() <= ls.LARGEST_BLOCK
