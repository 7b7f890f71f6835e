import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from passgrid.llm.quality_rules import RATIOS, Condition, DecisionList, Rule, apply_rules, fit_rules, learn
from passgrid.llm.text_stats import COUNTS, SYMBOLS, text_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    repeated = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    marks = lambda w: sum(33 <= ord(c) < 127 and not c.isalnum() for c in w)
    bare = [w for w in words if marks(w) == len(w)]
    return (
        len(words), sum(map(len, words)), sum(c in SYMBOLS for c in text), len(lines) - len(set(lines)), len(repeated),
        len(lines), len(set(words)), sum("A" <= c <= "Z" for c in text), sum("0" <= c <= "9" for c in text),
        marks(text), len(bare), sum(marks(w) >= 2 for w in words if w not in bare),
    )


def made_up_texts(n, seed=5):
    rng = random.Random(seed)
    bits = ["a", "b", "Ab", "c1", "é", "字", "😀x", "#", "$$", "x|y", "<b>", "!!", " ", "\x85", "　z", "\x00"]
    gaps = [" ", " ", "\n", "\t", "\r\n", "  ", "\x0b", "\n\n"]
    for _ in range(n):
        yield "".join(rng.choice(bits) + rng.choice(gaps) for _ in range(rng.randrange(0, 60)))


TEXTS = [
    None, "", " ", "\n", "\n\n", "a", "a\na\na", "a\na \na", "x\r\nx\r\n", "one two three four five " * 2, "a b c d e " * 500,
    "a " * 300_000, "\n".join(["same line here"] * 50), *made_up_texts(300),
]


def test_counts_agree_with_plain_python(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: tuple(r[c] for c in COUNTS) for r in text_counts(docs).collect()}
    assert got == {i: plain_counts(t) for i, t in rows}


def test_learns_conjunctions_in_order_and_prunes():
    rng = np.random.default_rng(1)
    values = rng.random((3000, len(RATIOS)))
    names = list(RATIOS)
    a, b, c = (values[:, names.index(x)] for x in ("symbols", "capitals", "variety"))
    bad = (a > 0.8) & (b > 0.5) | (c < 0.05)
    part = rng.integers(0, 3, len(values))
    rules = learn(values, bad, part)
    assert len(rules.rules) >= 2
    found = rules.first(values) > 0
    assert (found == bad).mean() > 0.98
    noise = learn(values, rng.random(len(values)) < 0.1, part)
    assert (noise.first(values) > 0).mean() < 0.02
    assert learn(values[:0], bad[:0], part[:0]) == DecisionList()
    assert learn(values, np.ones(len(values), bool), part) == DecisionList()


def test_expression_takes_the_first_rule_that_holds(spark):
    rules = DecisionList((
        Rule((Condition("symbols", True, 0.2), Condition("n_words", False, 12.0))),
        Rule((Condition("symbols", True, 0.1),)),
        Rule((Condition("variety", False, 0.2),)),
    ))
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: (r["base_failed"], r["rule"], r["kept"]) for r in apply_rules(docs, rules).collect()}
    for i, text in enumerate(TEXTS):
        counts = dict(zip(COUNTS, plain_counts(text)))
        values = np.array([[
            counts[t] if b is None else counts[t] / counts[b] if counts[b] else 0.0 for t, b in RATIOS.values()
        ]])
        failed = counts["n_words"] < 10 or 100 * counts["n_repeat_words"] > 20 * counts["n_words"]
        rule = int(rules.first(values)[0]) or None
        assert got[i] == (failed, rule, not failed and rule is None), text


def test_odd_tables(spark):
    docs = spark.createDataFrame(
        [(1, "a " * 20, 5, "x"), (1, "a " * 20, 5, "x"), (None, None, None, None)],
        "doc_id long, text string, n_words long, `Kept` string",
    )
    got = apply_rules(docs, DecisionList(), keep=["doc_id", "text", "n_words", "Kept"])
    assert got.columns == ["doc_id", "text", *COUNTS, "base_failed", "rule", "kept"]
    assert sorted((r["n_words"], r["base_failed"], r["kept"]) for r in got.collect()) == [
        (0, True, False), (20, True, False), (20, True, False)]
    assert apply_rules(docs.limit(0), DecisionList()).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0)], "doc_id long, quality int")
    assert fit_rules(docs, labels) == DecisionList()
    assert fit_rules(docs.limit(0), labels.limit(0)) == DecisionList()


@pytest.mark.parametrize("sf", ["0.01"])
def test_held_out_rows_of_the_test_tables(spark, sf):
    from passgrid.llm.columns import held_out, table

    docs, labels = (table(spark, f"/root/testdata/sf{sf}", t) for t in ("documents", "labels"))
    rules = fit_rules(docs, labels)
    assert rules.rules and "reject if" in str(rules)
    judged = apply_rules(docs, rules).join(labels, "doc_id").filter(held_out(F.col("doc_id")) & ~F.col("base_failed"))
    got = judged.groupBy().agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int")).alias("right")).first()
    assert got["right"] > 0.95
