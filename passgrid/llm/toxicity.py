"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features are built-in expressions over the words of a text: densities of a fixed lexicon, of learned words and of learned
stems, second person near a hit, capitals, punctuation and obfuscation. Trees and lexicon are fitted on a bounded sample of labelled
rows, the calibration on rows that the trees have not seen. Scoring is a projection; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passgrid.llm.columns import fresh, held_out, quoted, without
from passgrid.llm.training import labelled_sample
from passgrid.session import stage

SAMPLE_ROWS = 20_000
LEXICON_WORDS = 200
STEM = 5
LEAST_Z = 3.0
TREES, DEPTH = 20, 3
# Weight of the trees' own score, which orders rows inside a step of the calibration.
TIE_WEIGHT = 0.002

# ---- Fixed values: common insults and forms of address in the languages of the corpus ------------------------------
INSULTS = [
    "idiot", "idiots", "idiotic", "moron", "morons", "stupid", "dumb", "loser", "losers", "scum", "trash", "pathetic",
    "worthless", "clown", "fool", "imbecile", "jerk", "ugly", "disgusting", "hate", "garbage",
    "dumm", "blöd", "trottel", "depp", "arschloch", "abschaum", "versager",
    "imbécile", "crétin", "connard", "salaud", "ordure", "nul", "minable",
    "estúpido", "idiota", "imbécil", "basura", "patético", "inútil", "asqueroso",
]
SECOND_PERSON = [
    "you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "te",
    "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "vosotros", "usted", "ustedes", "vuestro",
]
LOOK_ALIKES = ("013457@$!|*", "oieastasiii")

FEATURES = [
    "words", "insults", "insult_density", "learned", "learned_density", "stems", "stem_density", "disguised", "disguised_density", "near_you",
    "you_density", "capitals", "shouted", "punctuation", "exclamations", "obfuscated", "spelled_out",
]
_NOT_WORD = r"[^\p{L}\p{N}]+"
_MASKED = r"(\b\p{L}++[0-9@$!|*]+\p{L}[\p{L}0-9@$!|*]*)"
NEAR_WORDS = 5


def words_of(text: Column) -> Column:
    return F.split(F.lower(text), _NOT_WORD)


def _near_you(words: Column, targets: list[str]) -> Column:
    """Hits with a second person at most ``NEAR_WORDS`` words away. Only the words around a hit are looked at, however
    many hits a text has."""
    others = [w for w in SECOND_PERSON if w not in targets]

    def near(own: Column, i: Column) -> Column:
        first = F.greatest(i + 1 - NEAR_WORDS, F.lit(1))
        return F.exists(F.slice(own, first, i + 2 + NEAR_WORDS - first), lambda w: w.isin(others))

    return _once(words, lambda own: F.size(F.filter(own, lambda w, i: w.isin(targets) & near(own, i))))


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with the value computed once, also where ``f`` uses it for each element of something."""
    return F.transform(F.array(value), f)[0]


def stem(word: Column) -> Column:
    return F.substring(word, 1, STEM)


def _with_counts(docs: DataFrame, text_col: str, lexicon: Lexicon) -> tuple[DataFrame, dict[str, str]]:
    """Adds what the features are made of: the text is read once for words, for capitals, for punctuation and for
    disguised words, and only the few words found are looked at again."""
    known = ["text", "words", "told", "stems", "caps", "marks", "masked", "near"]
    name = dict(zip(known, fresh(docs, *[f"_{k}" for k in known])))
    column = {k: quoted(v) for k, v in name.items()}
    targets = sorted({*INSULTS, *lexicon.words})
    told = F.filter(column["words"], lambda w: w.isin([*targets, *SECOND_PERSON]))
    first = docs.withColumn(name["text"], F.coalesce(quoted(text_col).cast("string"), F.lit("")))
    first = first.withColumn(name["words"], words_of(column["text"]))
    first = first.withColumns({
        name["told"]: told,
        name["stems"]: F.size(F.filter(column["words"], lambda w: (F.length(w) > STEM) & stem(w).isin(lexicon.stems)))
        if lexicon.stems else F.lit(0),
        name["caps"]: F.regexp_extract_all(column["text"], F.lit(r"(\p{Lu}+)")),
        name["marks"]: F.regexp_extract_all(column["text"], F.lit(r"([^\p{L}\p{N}\s]+)")),
        name["masked"]: F.transform(
            F.regexp_extract_all(F.lower(column["text"]), F.lit(_MASKED)), lambda w: F.translate(w, *LOOK_ALIKES)
        ),
    })
    hit = F.exists(column["told"], lambda w: w.isin(targets))
    return first.withColumn(name["near"], F.when(hit, _near_you(column["words"], targets)).otherwise(0)), name


def _features(name: dict[str, str], lexicon: Lexicon) -> dict[str, Column]:
    text, words, told, stems, caps, marks, masked, near = (quoted(name[k]) for k in name)
    n = F.greatest(F.size(words), F.lit(1)).cast("double")
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")

    def hits(among: Column, of: list[str]) -> Column:
        return (F.size(F.filter(among, lambda w: w.isin(of))) if of else F.lit(0)).cast("double")

    insults, learned = hits(told, INSULTS), hits(told, lexicon.words)
    disguised = hits(masked, sorted({*INSULTS, *lexicon.words}))
    return {
        "words": F.log1p(n),
        "insults": F.log1p(insults),
        "insult_density": insults / n,
        "learned": F.log1p(learned),
        "learned_density": learned / n,
        "stems": F.log1p(stems),
        "stem_density": stems / n,
        "disguised": F.log1p(disguised),
        "disguised_density": disguised / n,
        "near_you": near / n,
        "you_density": hits(told, SECOND_PERSON) / n,
        "capitals": F.length(F.array_join(caps, "")) / chars,
        "shouted": F.size(F.filter(caps, lambda w: F.length(w) > 2)) / n,
        "punctuation": F.length(F.array_join(marks, "")) / chars,
        "exclamations": F.size(F.filter(marks, lambda w: w.rlike("[!?]{2,}"))) / n,
        "obfuscated": F.size(masked) / n,
        "spelled_out": F.regexp_count(text, F.lit(r"(?:[ .*_-]\p{L}){3,}[ .*_-]")) / n,
    }


@dataclass
class Lexicon:
    """Learned words, and learned beginnings of longer words."""

    words: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)


@dataclass
class ToxicityModel:
    """What scoring needs. Without rows of both classes there are no trees and every text gets ``base``."""

    base: float
    lexicon: Lexicon
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None


def _with_features(docs: DataFrame, text_col: str, lexicon: Lexicon, vector: str) -> DataFrame:
    named, name = _with_counts(docs, text_col, lexicon)
    names = dict(zip(FEATURES, fresh(named, *[f"_f_{f}" for f in FEATURES])))
    values = _features(name, lexicon)
    named = named.select(
        *[quoted(c) for c in docs.columns], *[values[f].cast("double").alias(names[f]) for f in FEATURES]
    )
    return VectorAssembler(inputCols=list(names.values()), outputCol=vector).transform(named).drop(*names.values())


def _raw(frame: DataFrame, model: ToxicityModel, vector: str, out: str) -> DataFrame:
    raw, chance, label = fresh(frame, "_raw", "_chance", "_label")
    trees = model.trees.copy().setFeaturesCol(vector).setRawPredictionCol(raw).setProbabilityCol(chance)
    scored = trees.setPredictionCol(label).transform(frame)
    return scored.withColumn(out, vector_to_array(quoted(chance))[1]).drop(raw, chance, label)


def _telling(rows: DataFrame, found: Column, yes: int, no: int, most: int) -> list[str]:
    """The terms whose odds of standing in a toxic text are surest to be higher, ``most`` at most."""
    in_docs = rows.select("label", F.explode(F.array_distinct(found)).alias("term"))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    counts = in_docs.groupBy("term").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    odds = F.log(a / (yes + 1 - a)) - F.log(b / (no + 1 - b))
    best = (
        counts.filter("a >= 3")
        .select("term", (odds / F.sqrt(1 / a + 1 / b)).alias("z"), odds.alias("odds"))
        .filter((F.col("z") > LEAST_Z) & (F.col("odds") > 1.5))
        .orderBy(F.desc("z"), "term")
        .limit(most)
    )
    return [r["term"] for r in best.collect()]


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    lexicon_words: int = LEXICON_WORDS,
) -> ToxicityModel:
    """Fit on about ``sample_rows`` labelled rows at most, chosen by a hash of the id.

    Only rows whose crc32(id as text) modulo 5 is not 0 are read: remainder 1 calibrates, the others grow the trees and
    the lexicon. Labels other than 0 and 1 and rows without an id are ignored, the largest of several labels counts.
    """
    rows = labelled_sample(docs, labels, "toxic", id_col=id_col, rows=sample_rows, extra=(text_col,))
    rows = rows.select("id", "part", "label", quoted(text_col).cast("string").alias("text"))
    grown = rows.filter("part > 1")
    counts = {r["label"]: r["n"] for r in grown.groupBy("label").agg(F.count("*").alias("n")).collect()}
    yes, no = counts.get(1.0, 0), counts.get(0.0, 0)
    base = (yes + 1) / (yes + no + 2)
    if not yes or not no:
        return ToxicityModel(min(base, 0.49), Lexicon())
    words = F.filter(words_of(F.col("text")), lambda w: w.rlike(r"^\p{L}{3,}$"))
    longer = F.transform(F.filter(words, lambda w: F.length(w) > STEM), stem)
    told = [_telling(grown, found, yes, no, lexicon_words) for found in (words, longer)]
    lexicon = Lexicon(*told)
    model = ToxicityModel(base, lexicon)
    frame = stage(_with_features(rows, "text", lexicon, "features").select("part", "label", "features"), "features")
    model.trees = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7,
        minInstancesPerNode=2,
    ).fit(frame.filter("part > 1").coalesce(4))
    checked = frame.filter("part = 1")
    if len(checked.groupBy("label").count().take(2)) == 2:
        scored = _raw(checked, model, "features", "score")
        model.calibration = IsotonicRegression(featuresCol="score", labelCol="label").fit(scored.coalesce(1))
    return model


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents with ``held_out, score, predicted``; columns of those names are replaced.

    The score lies in 0 to 1, ``predicted`` is 1 from 0.5 on. Null and empty texts are scored as texts without words.
    Rows without an id are scored and not held out. Equal texts get equal scores. Whole texts are read.
    """
    vector, own, level = fresh(docs, "_vector", "_own", "_level")
    columns = without(docs, ["held_out", "score", "predicted"])
    if model.trees is None:
        scored = docs.withColumn(own, F.lit(model.base)).withColumn(level, F.lit(model.base))
    else:
        scored = _raw(_with_features(docs, text_col, model.lexicon, vector), model, vector, own)
        if model.calibration is None:
            scored = scored.withColumn(level, quoted(own))
        else:
            steps = model.calibration.copy().setFeaturesCol(own).setPredictionCol(level)
            scored = steps.transform(scored)
    value = quoted(level) * (1 - TIE_WEIGHT) + quoted(own) * TIE_WEIGHT
    return scored.select(
        *columns,
        held_out(quoted(id_col)).alias("held_out"),
        value.alias("score"),
        (value >= 0.5).cast("int").alias("predicted"),
    )
