"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
p AS (
  SELECT DISTINCT item_id, list_aggregate(w[i:i + least(len(w), 13) - 1], 'string_agg', ' ') AS phrase,
    least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
place AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d WHERE len(w) > 0),
o AS (
  SELECT run.r, run.i, p.n, p.item_id
  FROM (SELECT r, i, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS phrase
        FROM place, (SELECT DISTINCT n FROM p) WHERE i + n - 1 <= len(w)) run
  JOIN p ON p.phrase = run.phrase AND p.n = run.n
),
hit AS (
  SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT r, i, n, unnest(range(i, i + n)) AS j FROM o) GROUP BY r
),
items AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM o WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

_NGRAM_JOIN = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
k AS (SELECT doc_id, list_aggregate(w, 'string_agg', ' ') AS words, w FROM d WHERE len(w) > 0),
c AS (SELECT words, min(doc_id) AS class_id, count(*) AS members, any_value(w) AS w FROM k GROUP BY words),
s AS (
  SELECT DISTINCT class_id, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS shingle
  FROM (SELECT class_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM c)
),
n AS (SELECT class_id, count(*) AS n FROM s GROUP BY class_id),
both_ AS (
  SELECT a.class_id AS a, b.class_id AS b, count(*) AS same
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.class_id <> b.class_id GROUP BY a.class_id, b.class_id
),
link AS (
  SELECT a, b FROM both_ JOIN n x ON x.class_id = a JOIN n y ON y.class_id = b
  WHERE same >= 0.8 * (x.n + y.n - same) - 1e-9
),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
root AS (SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a),
near AS (SELECT a, sum(members) AS n FROM link JOIN c ON c.class_id = b GROUP BY a)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id,
  CAST(coalesce(members - 1 + coalesce(near.n, 0), 0) AS BIGINT) AS n_links,
  coalesce(component_id, c.class_id, d.doc_id) AS component_id,
  coalesce(component_id, c.class_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN c ON c.words = k.words
LEFT JOIN near ON near.a = c.class_id LEFT JOIN root ON root.a = c.class_id
"""

_EGO_JOIN = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
root AS (SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a),
near AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, CAST(coalesce(near.n, 0) AS BIGINT) AS n_links, coalesce(component_id, vec_id) AS component_id,
  coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN near ON near.a = vec_id LEFT JOIN root ON root.a = vec_id
"""

_SQUARE = "list_inner_product(x.c, x.c) - 2 * list_inner_product(x.c, k.c) + list_inner_product(k.c, k.c)"


def _assigned(r: int) -> str:
    """Round ``r``: each part's nearest entry of codebook ``r``, and its squared distance."""
    return f"""
a{r} AS MATERIALIZED (
  SELECT rid, p, min(d) AS d, min_by(e, (d, e)) AS e
  FROM (SELECT x.rid, x.p, k.e, {_SQUARE} AS d FROM x JOIN k{r} k ON x.p = k.p) GROUP BY rid, p
)"""


def _refitted(r: int) -> str:
    """Codebook ``r + 1``: floored means, unused entries as they were."""
    return f"""
k{r + 1} AS MATERIALIZED (
  SELECT k.p, k.e, coalesce(m.c, k.c) AS c
  FROM k{r} k LEFT JOIN (
    SELECT p, e, list(mean ORDER BY i) AS c
    FROM (SELECT p, e, i, floor(sum(x.c[i]) / count(*)) AS mean
          FROM a{r} JOIN x USING (rid, p), range(1, 17) AS t(i) GROUP BY p, e, i) GROUP BY p, e
  ) m ON m.p = k.p AND m.e = k.e
)"""


_VECTOR_CODES = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
    list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(1024 * x)) AS c
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
x AS MATERIALIZED (SELECT rid, p, c[16 * p + 1:16 * p + 16] AS c FROM v, range(4) AS t(p)),
k0 AS MATERIALIZED (SELECT p, rid - 1 AS e, c FROM x WHERE rid <= 256),
{",".join(_assigned(r) + "," + _refitted(r) for r in range(4))},
{_assigned(4)},
coded AS (
  SELECT rid, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a4 GROUP BY rid
),
book AS (
  SELECT sha256(string_agg(CAST(CAST(k.c[i] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS digest
  FROM k4 k, range(1, 17) AS t(i)
)
SELECT v.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM coded JOIN v USING (rid), book
"""

_RANKED_SEARCH = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, w, len(w) AS n FROM (SELECT doc_id, {_WORDS} AS w FROM documents) WHERE len(w) > 0
),
q AS MATERIALIZED (
  SELECT DISTINCT i, item_id, unnest(w) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, {_WORDS} AS w FROM benchmark)
),
f AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM d),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term, docs
),
score AS (
  SELECT i, item_id, r, doc_id,
    CAST(sum(weight.w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words)))) AS BIGINT) AS score
  FROM q JOIN f USING (term) JOIN weight USING (term) JOIN d USING (r), s GROUP BY i, item_id, r, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM score WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) <= 50
"""

ORACLE_SQL = {
    "op1_ego_join": _EGO_JOIN,
    "op3_ngram_jaccard_join": _NGRAM_JOIN,
    "op10_decontaminate": _DECONTAMINATE,
    "op11_vector_codes": _VECTOR_CODES,
    "op12_ranked_search": _RANKED_SEARCH,
}
