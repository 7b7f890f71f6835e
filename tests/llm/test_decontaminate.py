import random

import pytest
from test_words import plain_words

from passgrid.llm import decontaminate
from passgrid.llm.decontaminate import find_contamination


def brute(text, items, window=13):
    own = plain_words(text)
    hit, found = set(), set()
    for item, phrase in items:
        words = plain_words(phrase)
        for at in range(max(1, len(words) - window + 1) if words else 0):
            w = words[at : at + window]
            for i in range(len(own) - len(w) + 1):
                if own[i : i + len(w)] == w:
                    hit |= set(range(i, i + len(w)))
                    if item is not None:
                        found.add(item)
    return len(own), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(own)


def tables(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 4, 13, 14, 30])))) for i in range(12)]
    items += [(12, items[3][1]), (None, items[4][1] + " é"), (13, None), (14, "..."), (3, "Straße 5"), (12, items[3][1])]
    docs = []
    for i in range(80):
        words = [rng.choice(vocabulary + ["zzz", "yy"]) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 2)):
            phrase = rng.choice([p for _, p in items if p]).upper().split()
            at = rng.randint(0, len(words))
            words[at:at] = phrase[: rng.choice([13, len(phrase)])]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    return [*docs, (80, None), (81, ""), (81, ""), (None, "straße 5"), (82, "zz " * 100_000 + items[9][1])], items


@pytest.mark.parametrize("block", [20_000, 5])
def test_hits_are_those_of_plain_search(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_ROWS", block)
    docs, items = tables()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    asked = spark.createDataFrame(items, "item_id int, text string")
    got = find_contamination(frame, asked).collect()
    assert len(got) == len(docs)
    texts = dict(docs)
    for r in got:
        assert (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) == brute(texts[r["doc_id"]], items)
        inside = sum(len(plain_words((texts[r["doc_id"]] or "")[s["start"] : s["end"]])) for s in r["spans"])
        assert inside == r["n_hit"]


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id bigint, text string, n_hit int, _marks string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    (row,) = find_contamination(docs, none).collect()
    assert row["n_hit"] == 0 and row["_marks"] == "x" and row["items"] == [] and not row["contaminated"]
    asked = spark.createDataFrame([(1, "A")], "item_id bigint, text string")
    assert find_contamination(docs.limit(0), asked).count() == 0
    (row,) = find_contamination(docs, asked).collect()
    assert row["n_hit"] == 1 and row["contaminated"] and row["spans"][0]["end"] == 1


def test_long_items_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 40)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 17)
    docs, items = tables(2)
    rng = random.Random(3)
    long = " ".join(f"w{rng.randrange(60)}" for _ in range(70))
    items.append((20, long))
    docs += [(100 + i, " ".join(long.split()[i : i + 13])) for i in range(58)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = find_contamination(frame, spark.createDataFrame(items, "item_id int, text string")).collect()
    texts = dict(docs)
    for r in got:
        assert (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) == brute(texts[r["doc_id"]], items)


def test_driver_holds_neither_repeated_nor_giant_items(spark, monkeypatch):
    blocks = []

    def seen(self, pieces, ids, window, real=decontaminate.Phrases.__init__):
        blocks.append((len(pieces.flatten()), len(ids.flatten())))
        real(self, pieces, ids, window)

    monkeypatch.setattr(decontaminate.Phrases, "__init__", seen)
    phrase = " ".join(f"p{i}" for i in range(30))
    giant = spark.range(1).selectExpr(
        "1000000L AS item_id", "array_join(transform(sequence(1, 700000), i -> concat('g', i)), ' ') AS text"
    )
    equal = spark.range(50_000).selectExpr("id AS item_id", f"'{phrase}' AS text")
    docs = [(1, "x " + phrase), (2, " ".join(f"g{i}" for i in range(49_980, 50_020))), (3, "g5 g7")]
    found = find_contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), equal.unionByName(giant))
    got = {r["doc_id"]: r for r in found.collect()}
    assert got[1]["items"] == list(range(50_000)) and got[1]["n_hit"] == 30
    assert got[2]["items"] == [1_000_000] and got[2]["n_hit"] == 40
    assert got[3]["n_hit"] == 0
    # 50,000 rows of one text come as three lists of ids, a giant item as pieces, all within a block's words.
    assert sum(n for n, _ in blocks) < 702_000 and sum(n for _, n in blocks) < 50_100
