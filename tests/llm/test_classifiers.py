"""Toxicity, quality and licences: what is learned, odd rows, empty tables."""

import random
import textwrap
import zlib

import pytest
from pyspark.sql import functions as F

from passgrid.llm import licences, quality
from passgrid.llm.licences import TEMPLATES, fit_licences, scan_licences
from passgrid.llm.quality import fit_quality, score_quality
from passgrid.llm.toxicity import fit_toxicity, score_toxicity

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, _text int"


def corpus(n=700):
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "ba re ti lo mu".split() for b in "nar pet sil vo kum".split()]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 60))]
        toxic, good = int(i % 5 == 0), int(i % 4 != 0)
        for _ in range(3 * toxic):
            words.insert(rng.randint(0, len(words)), rng.choice(["idiot", "moron", "grubbel"]))
        if not good:
            words = [w + rng.choice(["%%%", "$$$", "###"]) for w in words]
        docs.append((i, " ".join(words), "en", f"s{i % 4 if rng.random() < 0.8 else i % 30}", 0, "x", 1))
        labels.append((i, good, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def data(spark):
    docs, labels = corpus()
    odd = [(9001, None, None, None, None, None, None), (9002, "", "en", "s1", 0, None, None), (9003, "", "en", "s1", 0, None, None),
           (None, "you idiot, you moron", "en", None, 0, None, None), (9004, "la " * 60_000, "en", "s1", 0, None, None)]
    more = [(None, 1, 1), (9001, None, None), (5, 7, 3), (0, 0, 1)]
    return (spark.createDataFrame(docs + odd, DOCS),
            spark.createDataFrame(labels + more, "doc_id bigint, quality int, toxic int"), dict((a, (b, c)) for a, b, c in labels))


def accuracy(rows, truth, k):
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert held
    return sum(r["predicted"] == truth[r["doc_id"]][k] for r in held) / len(held)


def test_toxicity_on_rows_kept_from_training(spark, data):
    docs, labels, truth = data
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    rows = scored.collect()
    assert scored.columns == ["doc_id", "text", "lang", "source", "n_chars", "_text", "held_out", "score", "predicted"]
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    for r in rows:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert accuracy(rows, truth, 1) > 0.97
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[None]["predicted"] == 1 and by_id[9001]["score"] == by_id[9002]["score"] == by_id[9003]["score"]
    assert by_id[9004]["predicted"] == 0


def test_toxicity_scores_need_no_labels_or_ids(spark, data):
    docs, labels, _ = data
    model = fit_toxicity(docs, labels)
    text_only = docs.select(F.lit(None).cast("bigint").alias("doc_id"), "text", F.lit("zz").alias("lang"))
    a = sorted(r["score"] for r in score_toxicity(docs, model).collect())
    assert a == pytest.approx(sorted(r["score"] for r in score_toxicity(text_only, model).collect()))


@pytest.mark.parametrize("label", ["none", "one class"])
def test_without_both_classes(spark, data, label):
    docs, labels, _ = data
    few = labels.limit(0) if label == "none" else labels.filter("toxic = 0 and quality = 1")
    rows = score_toxicity(docs, fit_toxicity(docs, few)).collect()
    assert len({r["score"] for r in rows}) == 1 and {r["predicted"] for r in rows} == {0}
    assert score_quality(docs, fit_quality(docs, few)).count() == len(rows)
    assert score_toxicity(docs.limit(0), fit_toxicity(docs.limit(0), labels)).count() == 0
    assert score_quality(docs.limit(0), fit_quality(docs.limit(0), labels)).count() == 0


def test_quality_shrinks_sparse_sites(spark, data):
    docs, labels, truth = data
    scored = score_quality(docs, fit_quality(docs, labels))
    rows = scored.collect()
    assert len(rows) == docs.count() and accuracy(rows, truth, 0) > 0.97
    # Against the sums by hand: a path's rate lies between its own mean and its host's rate.
    hosts, paths = {}, {}
    for r in rows:
        hosts.setdefault(r["source"], []).append(r["evidence"])
        paths.setdefault((r["source"], r["lang"]), []).append(r["evidence"])
    mean = (sum(map(sum, hosts.values())) + 1) / (len(rows) + 2)
    strengths = set()
    for r in rows:
        own = hosts[r["source"]]
        raw = sum(own) / len(own)
        low, high = sorted([raw, mean])
        assert low - 1e-9 <= r["host_rate"] <= high + 1e-9
        if abs(raw - mean) > 1e-3:
            strengths.add(round((sum(own) - len(own) * r["host_rate"]) / (r["host_rate"] - mean), 3))
        low, high = sorted([sum(paths[r["source"], r["lang"]]) / len(paths[r["source"], r["lang"]]), r["host_rate"]])
        assert low - 1e-9 <= r["path_rate"] <= high + 1e-9
    (k,) = strengths
    assert quality.WEAKEST <= k <= quality.STRONGEST


def test_sites_decide_between_equal_texts(spark):
    base, labels = corpus(400)
    same = "bavo bavo%%% tinar"
    rows = [(*d[:3], "good" if lab[1] else "bad", *d[4:]) for d, lab in zip(base, labels)]
    rows += [(5000, same, "en", "good", 0, None, None), (5001, same, "en", "bad", 0, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    model = fit_quality(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    got = {r["doc_id"]: r for r in score_quality(docs, model).filter("doc_id >= 5000").collect()}
    assert got[5000]["evidence"] == got[5001]["evidence"] and got[5000]["score"] > got[5001]["score"]


def test_licences_are_found_where_they_stand(spark):
    rng = random.Random(3)
    filler = [" ".join(rng.choice("the na ti lo mar pel of in".split()) for _ in range(12)) for _ in range(300)]
    rows, want = [], {}
    for i, line in enumerate(filler):
        lines = [line, rng.choice(filler), rng.choice(filler)]
        if i % 4 == 0:
            family = rng.choice(sorted(TEMPLATES))
            at = rng.randint(0, 3)
            lines.insert(at, rng.choice(TEMPLATES[family][:1]))
            want[i] = (family, at)
        elif i % 4 == 1:
            lines.append(rng.choice(licences.LOOK_ALIKES + ["He has a licence for the boat and for the car."]))
        rows.append((i, "\n".join(lines), "x"))
    rows += [(900, None, None), (901, "", "x"), (901, "", "x"), (902, "na " * 100_000 + "\nReleased under the MIT License.", "x"),
             (None, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, families string")
    model = fit_licences(docs)
    got = scan_licences(docs, model)
    found = {r["doc_id"]: r for r in got.collect()}
    assert got.columns == ["doc_id", "text", "families", "notices"] and got.count() == len(rows)
    for i in range(300):
        have = [(n["family"], n["line"]) for n in found[i]["notices"]]
        assert have == ([want[i]] if i in want else []), (i, rows[i][1])
    assert found[902]["families"] == ["MIT"] and found[None]["families"] == ["CC-BY-NC-4.0", "MIT"]
    assert len(found[None]["notices"]) == 3 and found[900]["families"] == []
    assert scan_licences(docs.limit(0), model).count() == 0


def test_licences_fit_on_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert scan_licences(docs, fit_licences(docs)).count() == 0


def test_wrapped_licences_are_found(spark):
    rng = random.Random(6)
    filler = [" ".join(rng.choice("the na ti lo mar pel of in".split()) for _ in range(12)) for _ in range(200)]
    bsd, mit = TEMPLATES["BSD"][3], TEMPLATES["MIT"][3]
    mpl = ["# This Source Code Form is subject to the terms of the Mozilla Public",
           "# License, v. 2.0. If a copy of the MPL was not distributed with this",
           "# file, You can obtain one at http://mozilla.org/MPL/2.0/."]
    wrapped = {1: ("MPL-2.0", mpl), 2: ("MPL-2.0", [x.replace("#", "REM") for x in mpl])}
    for width in (20, 40, 75):
        wrapped[width] = "BSD", textwrap.wrap(bsd, width)
        wrapped[100 + width] = "MIT", textwrap.wrap(mit, width)
    wrapped[3] = "BSD", bsd.split()
    rows = [(i, "\n".join([filler[0], *lines, filler[1]])) for i, (_, lines) in wrapped.items()]
    rows += [(1000 + i, x) for i, x in enumerate(filler)]
    # Wrapped prose that shares runs with templates.
    rows += [(2000, "He sent\na copy of\nthe letter\nsubject to\nthe terms of the post"), (2001, "a copy of\n\nwith or without")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["notices"] for r in scan_licences(docs, fit_licences(docs)).collect()}
    for i, notices in got.items():
        assert [(n["family"], n["line"]) for n in notices] == ([(wrapped[i][0], 1)] if i in wrapped else []), (i, notices)


def test_near_you_counts_hits_beside_a_second_person(spark):
    import random
    import time

    from pyspark.sql import functions as F

    from passgrid.llm.toxicity import NEAR_WORDS, SECOND_PERSON, _near_you

    rng, targets = random.Random(2), ["idiot", "worthless", "du"]
    texts = [[rng.choice(["you", "idiot", "a", "b", "c", "d", "e", "f", "du", "worthless"]) for _ in range(rng.randrange(60))] for _ in range(200)]
    long = ["you"] * 90_000 + ["x"] * 10 + ["idiot"] * 90_000

    def plain(words):
        you = {i for i, w in enumerate(words) if w in SECOND_PERSON and w not in targets}
        return sum(w in targets and any(i + d in you for d in range(-NEAR_WORDS, NEAR_WORDS + 1)) for i, w in enumerate(words))

    frame = spark.createDataFrame([(i, w) for i, w in enumerate(texts)], "i int, words array<string>")
    got = {r["i"]: r["n"] for r in frame.select("i", _near_you(F.col("words"), targets).alias("n")).collect()}
    assert got == {i: plain(w) for i, w in enumerate(texts)}
    frame = spark.createDataFrame([(" ".join(long),)], "t string").select(F.split("t", " ").alias("words"))
    begin = time.perf_counter()
    assert frame.select(_near_you(F.col("words"), targets).alias("n")).first()["n"] == 0
    assert time.perf_counter() - begin < 10
