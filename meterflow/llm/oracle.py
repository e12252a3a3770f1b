"""DuckDB text of the queries that SQL can express on whole tables."""

from __future__ import annotations

OP3 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size,
       d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""

OP4 = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
marked AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after,
    length(text) + length(text) - length(replace(replace(replace(replace(replace(text, '\\', ''), '#', ''), '<', ''), ':', ''), '?', '')) AS shown,
    CASE role WHEN 'system' THEN 6 WHEN 'user' THEN 4 WHEN 'assistant' THEN 9 END AS label
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
judged AS (
  SELECT *, CASE
    WHEN before IS NULL THEN role IN ('system', 'user')
    WHEN role = 'user' THEN before IN ('system', 'assistant')
    WHEN role = 'assistant' THEN before = 'user'
    ELSE false END AND (after IS NOT NULL OR role = 'assistant') AS fine
  FROM marked)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  sum(4 + label + 2 + shown + 8)::BIGINT AS formatted_chars,
  bool_and(fine) AS valid
FROM judged GROUP BY conv_id
"""

OP2 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS digest FROM p),
g AS (SELECT digest, max(page_id) AS response FROM d WHERE n >= 1000 GROUP BY digest)
SELECT d.page_id, d.n AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN g.digest IS NULL OR d.page_id IS NOT DISTINCT FROM g.response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.digest IS NULL OR d.page_id IS NOT DISTINCT FROM g.response THEN NULL ELSE g.response END AS refers_to
FROM d LEFT JOIN g ON d.n >= 1000 AND d.digest = g.digest
"""

OP11 = """
WITH lowered AS (SELECT row_number() OVER () AS row, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
terms AS (SELECT row, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM lowered),
sizes AS (SELECT row, count(*) AS n FROM terms GROUP BY row),
corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS all_terms FROM sizes),
postings AS (SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM terms GROUP BY row, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings CROSS JOIN corpus GROUP BY term, n_docs),
asked AS (SELECT row_number() OVER () AS item, item_id,
    unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
scored AS (
  SELECT a.item, any_value(a.item_id) AS item_id, p.row, any_value(p.doc_id) AS doc_id,
    sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (100 - 90 + ((90 * s.n * c.n_docs) // c.all_terms)))))::BIGINT AS score
  FROM asked a JOIN postings p USING (term) JOIN weights w USING (term) JOIN sizes s ON s.row = p.row CROSS JOIN corpus c
  GROUP BY a.item, p.row),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE = {"op2_warc": OP2, "op3_exact_dedup": OP3, "op4_chat_format": OP4, "op11_search": OP11}
