"""DuckDB SQL for the queries that SQL can express, by query name."""

from __future__ import annotations

import string

from casemart.llm import licences

# Four-word shingles, links at 0.85, and the smallest id that links reach.
JACCARD = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2),
                                      lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM worded),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM tokens a JOIN tokens b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_id AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles,
       least(doc_id, coalesce(l.b, doc_id)) AS component_id, coalesce(n_links, 0) AS n_links
FROM sets LEFT JOIN least_id l ON l.a = doc_id LEFT JOIN degree d ON d.a = doc_id"""

# Every 100-byte string as hex; the starts that are not the first; their union and what is left.
REPEATS = """
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, h, length(h) // 2 AS n FROM bytes),
starts AS (
  SELECT doc_id, h, unnest(range(0, greatest(n - 99, 0))) AS i FROM sized),
strings AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) AS g FROM starts),
again AS (
  SELECT doc_id, i FROM strings
  QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
edges AS (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100
                         THEN 0 ELSE 1 END AS new
  FROM again),
runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM edges)
  GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since
  FROM runs),
cut AS (
  SELECT s.doc_id, sum(b - a) AS gone, count(*) AS n_spans, max(b) AS last,
         string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept
  FROM gaps JOIN sized s USING (doc_id) GROUP BY s.doc_id)
SELECT s.doc_id, n AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM sized s LEFT JOIN cut USING (doc_id)"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_license_scan": licences.oracle(),
        "op8_jaccard_join": JACCARD,
        "op10_suffix_dedup": REPEATS,
    }
