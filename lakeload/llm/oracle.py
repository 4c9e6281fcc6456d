"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from lakeload.llm.queries import TOP_K

ORACLE: dict[str, str] = {
    "op2_hamming_top_k": f"""
WITH coded AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS bits FROM embeddings),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id,
         len(list_filter(list_zip(q.bits, r.bits), lambda z: z[1] <> z[2])) AS distance
  FROM coded q, coded r WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(distance AS INTEGER) AS distance
FROM ranked WHERE rank <= {TOP_K}""",
    "op12_segment_trees": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(total) AS lang_size FROM kept GROUP BY lang),
counts AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY w.lang, w.source, w.term),
sizes AS (SELECT lang, source, sum(n) AS size FROM counts GROUP BY lang, source),
groups AS (
  SELECT g.lang, g.source, coalesce(s.size, 0) AS size, l.v, l.lang_size
  FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source LEFT JOIN langs l ON l.lang = g.lang),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.size + 5 * g.v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (k.total + 5)) // (g.lang_size + 5 * g.v)::HUGEINT AS q
  FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
priced AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN priced p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM grid WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50""",
}
