"""Document quality by hierarchical empirical Bayes.

A classifier over dense features of the text gives each document its evidence. Documents of one path, paths of one host
and hosts of the corpus share rates of good documents: a host's rate is shrunk toward the corpus, a path's toward its
host, the more the fewer documents it has. How strongly is estimated from how much hosts, and paths within hosts,
differ beyond chance. A document's score is its own log-odds plus what its path, without the document itself, is better
or worse than the corpus.

All sums are grouped aggregates over every document, combined before the shuffle; the classifier alone is fitted on a
bounded sample.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passgrid.llm.columns import fresh, held_out, quoted, without
from passgrid.llm.training import labelled_sample
from passgrid.session import stage

SAMPLE_ROWS = 20_000
# Bounds of a prior's strength, in documents: hosts that differ by chance alone would give an infinite one.
WEAKEST, STRONGEST = 1.0, 1000.0
FEATURES = ["length", "word_size", "symbols", "capitals", "digits", "stops", "repeats", "lines", "runs", "variety"]


@dataclass
class QualityModel:
    """Without labelled rows of both classes there is no classifier and every document has the same evidence."""

    base: float
    classifier: LogisticRegressionModel | None = None


def _features(text: Column) -> dict[str, Column]:
    """Dense features of a text, all between 0 and about 10."""
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    words = F.split(F.trim(text), r"\s+")
    n = F.greatest(F.size(words), F.lit(1)).cast("double")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(x)) > 0)
    n_lines = F.greatest(F.size(lines), F.lit(1)).cast("double")
    return {
        "length": F.log10(chars),
        "word_size": F.least(chars / n, F.lit(50.0)) / 10,
        "symbols": F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s.,;:'\"-]")) / chars * 10,
        "capitals": F.regexp_count(text, F.lit(r"\p{Lu}")) / chars * 10,
        "digits": F.regexp_count(text, F.lit(r"\p{N}")) / chars * 10,
        "stops": F.regexp_count(text, F.lit(r"[.!?]\s")) / n * 10,
        "repeats": (1 - F.size(F.array_distinct(lines)) / n_lines) * 10,
        "lines": F.log10(n_lines),
        "runs": F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s]{2,}")) / n * 10,
        "variety": F.size(F.array_distinct(words)) / n * 10,
    }


def _with_features(docs: DataFrame, text_col: str, vector: str) -> DataFrame:
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    names = dict(zip(FEATURES, fresh(docs, *[f"_f_{f}" for f in FEATURES])))
    values = _features(text)
    named = docs.select(*[quoted(c) for c in docs.columns], *[values[f].alias(names[f]) for f in FEATURES])
    return VectorAssembler(inputCols=list(names.values()), outputCol=vector).transform(named).drop(*names.values())


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS
) -> QualityModel:
    """Fit the classifier on about ``sample_rows`` labelled rows at most, none of them held out (crc32(id as text)
    modulo 5 is 0). Labels other than 0 and 1 and rows without an id are ignored."""
    rows = labelled_sample(docs, labels, "quality", id_col=id_col, rows=sample_rows, extra=(text_col,))
    frame = stage(_with_features(rows, text_col, "features").select("label", "features"), "features")
    counts = {r["label"]: r["n"] for r in frame.groupBy("label").agg(F.count("*").alias("n")).collect()}
    good, bad = counts.get(1.0, 0), counts.get(0.0, 0)
    base = (good + 1) / (good + bad + 2)
    if not good or not bad:
        return QualityModel(base)
    trained = LogisticRegression(featuresCol="features", labelCol="label", regParam=1e-3, maxIter=60).fit(frame)
    return QualityModel(base, trained)


def evidence(docs: DataFrame, model: QualityModel, out: str, *, text_col: str = "text") -> DataFrame:
    """The documents with the classifier's probability of being good."""
    if model.classifier is None:
        return docs.withColumn(out, F.lit(model.base))
    vector, raw, chance, label = fresh(docs, "_vector", "_raw", "_chance", "_label")
    trained = model.classifier.copy().setFeaturesCol(vector).setRawPredictionCol(raw)
    trained = trained.setProbabilityCol(chance).setPredictionCol(label)
    scored = trained.transform(_with_features(docs, text_col, vector))
    sure = F.greatest(F.least(vector_to_array(quoted(chance))[1], F.lit(1 - 1e-6)), F.lit(1e-6))
    return scored.withColumn(out, sure).drop(vector, raw, chance, label)


def _strength(groups: DataFrame, n: Column, rate: Column, center: Column) -> float:
    """Documents that a prior is worth, by moments: chance alone spreads a group's rate by r (1 - r) / n, the rest of
    the spread is between groups."""
    sums = groups.agg(
        F.sum(n).alias("n"),
        F.sum(n * (rate - center) * (rate - center)).alias("spread"),
        F.sum(center * (1 - center) * n).alias("chance"),
        F.count("*").alias("groups"),
    ).first()
    if not sums["n"] or sums["groups"] < 2:
        return STRONGEST
    noise = sums["chance"] / sums["n"]
    between = sums["spread"] / sums["n"] - noise * sums["groups"] / sums["n"]
    return STRONGEST if between <= 0 else min(STRONGEST, max(WEAKEST, noise / between - 1))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def score_quality(
    docs: DataFrame,
    model: QualityModel,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    path_col: str = "lang",
) -> DataFrame:
    """The documents with ``held_out, evidence, host_rate, path_rate, score, predicted``; columns of those names are
    replaced.

    A path is a pair of ``host_col`` and ``path_col``; null is a value like any other in both. ``evidence`` is the
    classifier's probability, ``host_rate`` and ``path_rate`` are the posterior rates, ``score`` (0 to 1) combines them,
    ``predicted`` is 1 from 0.5 on. Null and empty texts are scored as texts without words. Repeated rows count each.
    """
    out = ["held_out", "evidence", "host_rate", "path_rate", "score", "predicted"]
    p, host, path = fresh(docs, "_p", "_host", "_path")
    scored = evidence(docs, model, p, text_col=text_col).withColumns({
        host: F.xxhash64(quoted(host_col).cast("string").isNull(), quoted(host_col).cast("string")),
        path: F.xxhash64(quoted(path_col).cast("string").isNull(), quoted(path_col).cast("string")),
    })
    sums = stage(
        scored.groupBy(quoted(host).alias("host"), quoted(path).alias("path")).agg(
            F.count("*").alias("n"), F.sum(quoted(p)).alias("s")
        ),
        "paths",
    )
    hosts = sums.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    n, s = hosts.agg(F.sum("host_n"), F.sum("host_s")).first()
    center = (s + 1) / (n + 2) if n else model.base
    k_host = _strength(hosts, F.col("host_n"), F.col("host_s") / F.col("host_n"), F.lit(center))
    rate = (F.col("host_s") + k_host * center) / (F.col("host_n") + k_host)
    both = stage(sums.join(hosts.withColumn("host_rate", rate), "host"), "rates")
    k_path = _strength(both, F.col("n"), F.col("s") / F.col("n"), F.col("host_rate"))
    names = fresh(scored, "_h", "_p2", "_n", "_s", "_host_rate")
    rates = both.select(*[F.col(a).alias(b) for a, b in zip(["host", "path", "n", "s", "host_rate"], names)])
    joined = scored.join(
        rates, (quoted(host) == quoted(names[0])) & (quoted(path) == quoted(names[1]))
    )
    size, total, prior = quoted(names[2]), quoted(names[3]), quoted(names[4])
    path_rate = (total + k_path * prior) / (size + k_path)
    # Without the document itself, which has given its evidence already.
    others = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), (total - quoted(p) + k_path * prior) / (size - 1 + k_path)))
    odds = _logit(quoted(p)) + _logit(others) - _logit(F.lit(center))
    score = 1 / (1 + F.exp(-odds))
    return joined.select(
        *without(docs, out),
        held_out(quoted(id_col)).alias("held_out"),
        quoted(p).alias("evidence"),
        prior.alias("host_rate"),
        path_rate.alias("path_rate"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
    )
