"""The similarity joins against all pairs."""

import random
import uuid
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from passgrid.llm import ego_join, ngram_join
from passgrid.llm import links as links_module
from passgrid.llm.ego_join import near_vectors
from passgrid.llm.links import components
from passgrid.llm.ngram_join import drop_near_duplicates, least_matches, near_duplicates
from test_words import plain_words


def reach(ids, links):
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    root, out = {}, {}
    for i in ids:
        if i in root:
            continue
        todo, group = [i], set()
        while todo:
            x = todo.pop()
            if x not in group:
                group.add(x)
                todo += near[x]
        for x in group:
            root[x] = group
    for i in ids:
        out[i] = (len(near[i]), min(root[i]))
    return out


def shingles(text):
    own = plain_words(text)
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def brute_documents(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and len(x & y) >= 0.8 * len(x | y) - 1e-9:
                links.append((a, b))
    return reach(ids, links)


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 40, 120]))]
        for _ in range(rng.randint(1, 6)):
            copy = list(words)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy))
    rows += ["one two", "one, two!", "One Two", "one", "", None, "...", "same passage " * 40]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("chunk", [1024, 2])
def test_ngram_join_is_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(ngram_join, "CHUNK_CLASSES", chunk)
    rows = corpus()
    got = near_duplicates(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    want = brute_documents(rows)
    assert {r["doc_id"]: (r["n_links"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got) and len(got) == len(rows)


def test_ngram_join_odd_rows(spark):
    long = " ".join(f"x{i % 977}" for i in range(200_000))
    rows = [(1, "a b c d e f", 0), (1, "a b c d e f", 0), (None, "a b c d e f", 1), (2, None, 2), (None, None, 3),
            (5, long, 4), (6, long + " end", 5), (7, "", 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, cls int")
    got = [(r["doc_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (2, 0, 2, True), (None, 0, None, True),
         (5, 1, 5, True), (6, 1, 5, False), (7, 0, 7, True)], key=str)
    left = drop_near_duplicates(docs)
    assert left.schema == docs.schema
    assert sorted((r["doc_id"], r["cls"]) for r in left.filter("doc_id is not null").collect()) == [
        (1, 0), (2, 2), (5, 4), (7, 6)]
    assert left.filter("doc_id is null").count() == 1
    assert near_duplicates(docs.limit(0)).count() == 0 and drop_near_duplicates(docs.limit(0)).count() == 0


def test_dropping_keeps_one_of_each_group(spark):
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted(i for i, (_, root) in brute_documents(rows).items() if i == root)
    assert sorted(r["doc_id"] for r in drop_near_duplicates(docs).collect()) == want


def test_crowd_of_near_copies_leaves_no_pairs(spark):
    base = [f"v{i}" for i in range(60)]
    rows = [(i, " ".join([*base, f"tail{i}"])) for i in range(400)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {(r["n_links"], r["component_id"]) for r in got.collect()} == {(399, 0)}


def test_bound_of_matches_rises():
    need = least_matches(0.8)
    assert (np.diff(need) > 0).all() and need[0] < 0.8 * 16 and need[-1] < 0.8 * 128


def brute_vectors(rows, threshold=0.98):
    fine = []
    for i, v, label in rows:
        if v is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        v = np.array(v, np.float32).astype(np.float64)
        fine.append((i, v / np.sqrt((v * v).sum()), label))
    links = [
        (a, b) for k, (a, x, p) in enumerate(fine) for b, y, q in fine[k + 1 :]
        if p == q and len(x) == len(y) and x @ y >= threshold
    ]
    return reach([r[0] for r in rows], links)


@pytest.mark.parametrize("block", [2048, 7])
def test_ego_join_is_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ego_join, "LEAF_ROWS", 3)
    rng = np.random.default_rng(1)
    rows = []
    for label in (0, 1, 2):
        for _ in range(12):
            center = rng.normal(size=6)
            for _ in range(rng.integers(1, 7)):
                v = center + rng.normal(size=6) * rng.choice([0.0, 0.03, 0.12])
                rows.append((len(rows), [float(x) for x in v * rng.choice([1.0, 3.0])], label))
    odd = [None, [], [0.0] * 6, [float("nan")] * 6, [float("inf")] + [1.0] * 5, [None] + [1.0] * 5, [1.0, 2.0], [1.0, 2.0]]
    rows += [(len(rows) + k, v, 0) for k, v in enumerate(odd)]
    rows += [(len(rows), rows[0][1], None), (len(rows) + 1, rows[0][1], 1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = near_vectors(table, block_rows=block).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == brute_vectors(rows)


def test_ego_join_odd_tables(spark):
    schema = "vec_id bigint, embedding array<float>, label int, cls string, members int"
    assert near_vectors(spark.createDataFrame([], schema)).count() == 0
    v = [1.0, 0.5, 0.0]
    rows = [(4, v, 1, "a", 1), (4, v, 1, "a", 1), (None, v, 1, "b", 2), (2, [2.0, 1.0, 0.0], 1, None, None)]
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in
                  near_vectors(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(4, 3, 2, False), (4, 3, 2, False), (None, 3, 2, False), (2, 3, 2, True)], key=str)


@pytest.mark.parametrize("local", [200_000, 20])
def test_components_of_chains_and_stars(spark, monkeypatch, local):
    monkeypatch.setattr(links_module, "LOCAL_LINKS", local)
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200), (None, 3)]
    links += [(300 + i, 300 + rng.randint(0, i)) for i in range(1, 60)]
    rng.shuffle(links)
    got = components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b")
    roots = {r["node"]: r["root"] for r in got.collect()}
    clean = [(a, b) for a, b in links if a is not None and a != b]
    want = {i: root for i, (_, root) in reach({x for p in clean for x in p}, clean).items()}
    assert roots == want and got.count() == len(want)
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").filter(F.lit(True)).count() == 0


def test_links_of_one_star_are_dealt_evenly(spark, monkeypatch, tmp_path):
    """Ten times as many links of one root as a portion should hold: no task contracts many more than that."""
    contract = links_module._contract

    def counted(batches):
        batches = list(batches)
        (tmp_path / f"{uuid.uuid4().hex}").write_text(str(sum(b.num_rows for b in batches)))
        yield from contract(iter(batches))

    monkeypatch.setattr(links_module, "LOCAL_LINKS", 2_000)
    monkeypatch.setattr(links_module, "_contract", counted)
    links = spark.range(1, 20_001).select(F.col("id").alias("a"), F.lit(0).cast("bigint").alias("b"))
    assert {r["root"] for r in components(links, "a", "b").collect()} == {0}
    sizes = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert sum(sizes) >= 20_000 and max(sizes) < 3_000
