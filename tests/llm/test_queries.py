"""Registered queries against their SQL, their columns, and the pipeline against its operators."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from passgrid.llm.columns import table
from passgrid.llm.decontaminate import find_contamination
from passgrid.llm.mixing import mix_sources
from passgrid.llm.ngram_join import near_duplicates
from passgrid.llm.oracle import ORACLE_SQL
from passgrid.llm.queries import QUERIES
from passgrid.llm.toxicity import fit_toxicity, score_toxicity

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")

COLUMNS = {
    "op1_ego_join": ["vec_id:bigint", "n_links:bigint", "component_id:bigint", "kept:boolean"],
    "op4_secrets": ["doc_id:bigint", "n_assign:bigint", "n_access:bigint", "n_hex:bigint", "base_sha256:string", "spans:string"],
    "op5_toxicity": ["doc_id:bigint", "held_out:boolean", "score:double", "predicted:int"],
    "op6_shard_by_bytes": ["doc_id:bigint", "size:bigint", "text_crc32:bigint", "law:string", "shard:int", "slot:bigint",
                           "grown_shard:int"],
    "op7_mix_sources": ["doc_id:bigint", "size:bigint", "source_size:bigint", "target:double", "taken:bigint"],
    "op9_html_text": ["page_id:bigint", "url:string", "text:string", "n_chars:bigint"],
    "op10_decontaminate": ["doc_id:bigint", "n_words:bigint", "n_hit:bigint", "n_items:bigint", "items_sha256:string",
                           "contaminated:boolean"],
    "op11_vector_codes": ["vec_id:bigint", "code:string", "error:bigint", "label_error:bigint", "codebooks_sha256:string"],
    "op13_quality_rules": ["doc_id:bigint", "n_words:bigint", "word_chars:bigint", "n_symbols:bigint", "n_dup_lines:bigint",
                           "n_repeat_words:bigint", "base_failed:boolean", "kept:boolean"],
}
TABLE = {"op1_ego_join": "embeddings", "op11_vector_codes": "embeddings", "op9_html_text": "pages"}


@pytest.fixture(scope="module")
def results(spark):
    return {}


def rows_of(spark, results, name):
    if name not in results:
        results[name] = QUERIES[name](spark, DATA).toPandas()
    return results[name]


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_agrees_with_sql(spark, results, name):
    con = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got, want = rows_of(spark, results, name), con.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    assert sorted(map(repr, got[order].itertuples(index=False, name=None))) == sorted(
        map(repr, want[order].itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", [q for q in QUERIES if q != "op12_ranked_search"])
def test_one_row_for_each_row(spark, results, name):
    source = table(spark, DATA, TABLE.get(name, "documents"))
    key = source.columns[0]
    got = rows_of(spark, results, name)
    assert sorted(got[key]) == sorted(r[0] for r in source.select(key).collect())
    kinds = [f"{a}:{b}" for a, b in QUERIES[name](spark, DATA).dtypes] if name in COLUMNS else []
    assert kinds[: len(COLUMNS.get(name, []))] == COLUMNS.get(name, [])


def test_search_ranks_from_one(spark, results):
    got = rows_of(spark, results, "op12_ranked_search")
    assert [f"{a}:{b}" for a, b in QUERIES["op12_ranked_search"](spark, DATA).dtypes] == [
        "item_id:bigint", "rank:int", "doc_id:bigint", "score:bigint"]
    for _, own in got.groupby("item_id"):
        assert sorted(own["rank"]) == list(range(1, len(own) + 1))


def ids(frame):
    return Counter(r["doc_id"] for r in frame.select("doc_id").collect())


def test_pipeline_stages_do_what_their_operators_find(spark):
    docs = table(spark, DATA, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_copies", "decontamination", "mixing", "sharding"]

    left = stages["toxicity"](spark, docs, DATA)
    scored = score_toxicity(docs, fit_toxicity(docs, table(spark, DATA, "labels")))
    assert left.schema == docs.schema and ids(left) == ids(scored.filter("predicted = 0"))
    found = near_duplicates(docs)
    left = stages["near_copies"](spark, docs, DATA)
    assert left.schema == docs.schema and ids(left) == ids(found.filter("kept"))
    left = stages["decontamination"](spark, docs, DATA)
    clean = find_contamination(docs, table(spark, DATA, "benchmark")).filter("not contaminated")
    assert left.schema == docs.schema and ids(left) == ids(clean)
    left = stages["mixing"](spark, docs, DATA)
    copies = {r["doc_id"]: r["copies"] for r in mix_sources(docs).collect() if r["copies"]}
    assert left.schema == docs.schema and ids(left) == Counter(copies)


def test_pipeline_keeps_other_columns(spark):
    docs = table(spark, DATA, "documents").selectExpr("*", "'a' AS predicted", "1 AS cls", "2 AS copies", "3 AS items")
    for name, function in corpus_pipeline.STAGES[:-1]:
        left = function(spark, docs, DATA)
        assert left.columns == docs.columns, name
        assert {tuple(r) for r in left.select("predicted", "cls", "copies", "items").distinct().collect()} == {("a", 1, 2, 3)}
        assert function(spark, docs.limit(0), DATA).count() == 0


def test_pipeline_ends_in_shards(spark):
    got = corpus_pipeline.run(spark, DATA).toPandas()
    assert set(got["shard"]) <= set(range(40)) and len(got) > 100
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
