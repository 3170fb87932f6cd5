"""SQL twins of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from contestry.llm.block_search import SEARCH_SQL
from contestry.llm.line_dedup import LINE_SQL
from contestry.llm.preferences import PREFERENCE_SQL
from contestry.llm.turn_repair import REPAIR_SQL

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
    GROUP BY x.doc_id, y.doc_id) p
  JOIN sizes u ON u.doc_id = p.a JOIN sizes v ON v.doc_id = p.b WHERE 100 * common >= 80 * (u.n + v.n - common)
), edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reached(doc_id, other) AS (
  SELECT a, b FROM edges UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON e.a = r.other
), roots AS (
  SELECT doc_id, min(other) AS other FROM reached GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(other, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(other, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN roots USING (doc_id)
"""

DECONTAMINATION = rf"""
WITH items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_LOW}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark
), known AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT item, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)
), words AS (
  SELECT doc_id, regexp_extract_all({_LOW}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents
), windows AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words CROSS JOIN (SELECT DISTINCT k FROM known) WHERE len(w) >= k)
), hits AS (
  SELECT doc_id, k, i, item FROM windows JOIN known USING (k, s)
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

REPEATED_SPANS = """
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), strings AS (
  SELECT doc_id, i, substr(h, 2 * i - 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 - 48)) AS i FROM texts WHERE length(h) >= 100)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS owner FROM strings) WHERE owner < doc_id
), runs AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM repeated)
), spans AS (
  SELECT doc_id, min(i) AS first, max(i) + 49 AS last FROM runs GROUP BY doc_id, run
), pieces AS (
  SELECT doc_id, first, last, coalesce(lag(last) OVER (PARTITION BY doc_id ORDER BY first), 0) AS before FROM spans
), cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(last - first + 1)::BIGINT AS n_removed, max(last) AS upto,
    string_agg(substr(h, 2 * before + 1, 2 * (first - 1 - before)), '' ORDER BY first) AS kept
  FROM pieces JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE kept || substr(h, 2 * upto + 1) END)) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""

EXACT_DEDUP = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_LOW} AS t FROM documents) WINDOW same AS (PARTITION BY t)
"""

ORACLE_SQL = {
    "op2_near_duplicates": NEAR_DUPLICATES,
    "op3_decontamination": DECONTAMINATION,
    "op4_repeated_spans": REPEATED_SPANS,
    "op5_preference_pairs": PREFERENCE_SQL,
    "op6_exact_dedup": EXACT_DEDUP,
    "op11_line_dedup": LINE_SQL,
    "op12_ranked_search": SEARCH_SQL,
    "op13_turn_repair": REPAIR_SQL,
}
