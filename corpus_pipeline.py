"""Five stages from documents to shards; each works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from passgrid.llm.columns import table
from passgrid.llm.decontaminate import find_contamination
from passgrid.llm.mixing import mix_sources
from passgrid.llm.ngram_join import drop_near_duplicates
from passgrid.llm.shards import shard_documents
from passgrid.llm.stages import copied, only
from passgrid.llm.toxicity import fit_toxicity, score_toxicity
from passgrid.session import stage


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return only(docs, lambda named: score_toxicity(named, model), "predicted = 0")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of the benchmark go."""
    benchmark = table(spark, sf_dir, "benchmark")
    return only(docs, lambda named: find_contamination(named, benchmark), "not contaminated")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return copied(docs, mix_sources)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and place in it."""
    return shard_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# SQL can't express the stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
