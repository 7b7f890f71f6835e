"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passgrid.llm.columns import table
from passgrid.llm.decontaminate import find_contamination
from passgrid.llm.ego_join import near_vectors
from passgrid.llm.html_text import extract_text, fit_pages
from passgrid.llm.lexical_search import search_documents
from passgrid.llm.licences import fit_licences, scan_licences
from passgrid.llm.mixing import mix_sources
from passgrid.llm.ngram_join import near_duplicates
from passgrid.llm.quality import fit_quality, score_quality
from passgrid.llm.quality_rules import apply_rules, fit_rules
from passgrid.llm.secrets import fit_field, scan_secrets
from passgrid.llm.shards import shard_documents
from passgrid.llm.toxicity import fit_toxicity, score_toxicity
from passgrid.llm.vector_codes import books_sha256, code_text, code_vectors, with_label_errors


def op1_ego_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id", "held_out", "score", "predicted", "evidence", "host_rate", "path_rate"
    )


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_links", "component_id", "kept"
    )


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_secrets(docs, fit_field(docs)).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_field"
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select("doc_id", "held_out", "score", "predicted")


def op6_shard_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licences(docs, fit_licences(docs), keep=["doc_id"]).select(
        "doc_id", F.array_join("families", ",").alias("families"), F.size("notices").cast("bigint").alias("n_notices")
    )


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract_text(pages, fit_pages(pages)).select("page_id", "url", "text", "n_chars")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        "contaminated",
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = code_vectors(table(spark, sf_dir, "embeddings"))
    return with_label_errors(coded, "label", "label_error").select(
        "vec_id", code_text(F.col("codes")).alias("code"), "error", "label_error",
        F.lit(books_sha256(books)).alias("codebooks_sha256"),
    )


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return apply_rules(docs, fit_rules(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_ego_join, op2_quality, op3_ngram_jaccard_join, op4_secrets, op5_toxicity, op6_shard_by_bytes, op7_mix_sources,
        op8_licences, op9_html_text, op10_decontaminate, op11_vector_codes, op12_ranked_search,
        op13_quality_rules,
    )
}
