"""DuckDB SQL for the operators that SQL can express.

Sharding needs a CRC-32, mixing a seeded hash, packing a tokenizer, the licence scan hundreds of
patterns, the classifiers training, the language model nested discounts over counts of counts and
whitening eigenvectors: these have none and are tested against brute force.
"""

from __future__ import annotations

_COMPONENTS = """
reach(id, other) AS (
  SELECT id, id FROM nodes
  UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
)"""

TOPK = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

JACCARD = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '\\s+'), lambda w: w <> '') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
    ELSE list_transform(generate_series(1, len(w) - 4), lambda i: w[i:i + 4]) END) AS g
  FROM split
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE c >= 0.8 * (s.n + t.n - c) - 1e-9
), nodes AS (SELECT doc_id AS id FROM documents), {_COMPONENTS},
found AS (
  SELECT id AS doc_id, min(other) AS class_id FROM reach GROUP BY id
), counts AS (
  SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a
), copies AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN 1 ELSE count(*) OVER (PARTITION BY w) END AS n FROM split
)
SELECT f.doc_id, f.class_id, coalesce(c.n, 0)::BIGINT AS n_links, k.n::BIGINT AS n_copies, f.doc_id = f.class_id AS kept
FROM found f LEFT JOIN counts c USING (doc_id) JOIN copies k USING (doc_id)
"""

CAPS = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b
  FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= 0.93
), nodes AS (SELECT vec_id AS id FROM embeddings), {_COMPONENTS},
found AS (
  SELECT id AS vec_id, min(other) AS component_id FROM reach GROUP BY id
), counts AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT f.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, f.component_id, f.vec_id = f.component_id AS kept
FROM found f LEFT JOIN counts c USING (vec_id)
"""

WARC = """
WITH paid AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM paid
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
FROM firsts
"""

_TERMS = """regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

LEXICAL = f"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS doc, {_TERMS} AS terms FROM documents
), sizes AS (
  SELECT doc, doc_id, len(terms)::BIGINT AS n FROM split WHERE len(terms) > 0
), whole AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes
), postings AS (
  SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM split) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), whole
), asked AS (
  SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)
), scored AS (
  SELECT item_id, doc, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (doc), whole
  GROUP BY item_id, doc
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scored JOIN sizes USING (doc) WHERE score > 0
)
WHERE rank <= 50
"""

SQL = {
    "op1_exact_topk": TOPK,
    "op5_ngram_jaccard_join": JACCARD,
    "op9_spherical_caps": CAPS,
    "op10_warc_dictionary": WARC,
    "op12_length_strata": LEXICAL,
}
