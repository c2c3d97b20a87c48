"""DuckDB SQL for the rows of those document queries that SQL can express."""

from __future__ import annotations

import string

_LOWER = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

RANKED_SEARCH = f"""
WITH docs AS (
  SELECT row_number() OVER () AS place, doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL
), lengths AS (
  SELECT place, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0
), totals AS (
  SELECT count(*) AS docs_all, CAST(sum(n) AS BIGINT) AS terms_all FROM lengths
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark
), held AS (
  SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(terms) AS term FROM docs) GROUP BY place, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(docs_all) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, totals WHERE term IN (SELECT term FROM wanted) GROUP BY term
), scored AS (
  SELECT item_id, place, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs_all) // terms_all))))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN held USING (term) JOIN lengths USING (place), totals
  GROUP BY item_id, place, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# Blanks of a row's text, and the best ways as text: nine digits of cost, then the edits; the least text is the cheapest way.
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _then(way: str, cost: str, edit: str) -> str:
    return f"CASE WHEN {way} IS NOT NULL THEN lpad(CAST(CAST(left({way}, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || substr({way}, 10) || {edit} END"


def _stay(way: str, role: str) -> str:
    return _then(way, f"cut + CASE WHEN initial = '{role}' THEN 0 ELSE 1 END", f"CASE WHEN initial = '{role}' THEN 'K' ELSE 'R' END")


CONVERSATION_REPAIR = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS named
  FROM conversations
), hashed AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(named) + 1), lambda i: CAST(ascii(named[i]) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM keyed, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hashed WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (ORDER BY conv_id, turn NULLS FIRST, role, text) AS place FROM damaged
), ordered AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial, rtrim(text, {_SPACE}) AS said,
    row_number() OVER (PARTITION BY conv_id ORDER BY place) AS k,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) AS again
  FROM placed
), judged AS (
  SELECT conv_id, turn, role, text, initial, k,
    CASE WHEN said = '' THEN 'blank' WHEN again > 1 THEN 'duplicate' WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY k) || initial NOT IN ('su', 'ua', 'au') AS odd
  FROM ordered
), steps AS (
  SELECT conv_id, k, initial, fault NOT IN ('blank', 'duplicate') AS keep, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS cut FROM judged
), ways AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS k, '000000000' AS s0, CAST(NULL AS VARCHAR) AS s1, '000000005I' AS s2, '000000010II' AS s3
  FROM steps
  UNION ALL
  SELECT conv_id, k, s0, s1, s2, least(s3, {_then("s2", "5", "'I'")}) FROM (
    SELECT conv_id, k, p0 AS s0, p1 AS s1,
      least(p2, {_then("p0", "5", "'I'")}, {_then("p1", "5", "'I'")}, {_then("p3", "5", "'I'")}) AS s2, p3 AS s3
    FROM (
      SELECT w.conv_id, r.k, {_then("s0", "2", "'D'")} AS p0,
        least({_then("s1", "2", "'D'")}, CASE WHEN keep AND initial = 's' THEN {_then("s0", "cut", "'K'")} END) AS p1,
        least({_then("s2", "2", "'D'")}, CASE WHEN keep THEN least({_stay("s0", "u")}, {_stay("s1", "u")}, {_stay("s3", "u")}) END) AS p2,
        least({_then("s3", "2", "'D'")}, CASE WHEN keep THEN {_stay("s2", "a")} END) AS p3
      FROM ways w JOIN steps r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.k = w.k + 1))
), ended AS (
  SELECT conv_id, arg_max(least(s0, s3), k) AS way FROM ways GROUP BY conv_id
), audits AS (
  SELECT conv_id, CAST(left(way, 9) AS BIGINT) AS cost, substr(way, 10) AS audit FROM ended
), edits AS (
  SELECT conv_id, audit[i] AS edit, i, length(replace(left(audit, i), 'I', '')) AS k, length(replace(left(audit, i), 'D', '')) AS written
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS i FROM audits)
), joined AS (
  SELECT e.conv_id, e.edit, e.i, e.written, CASE WHEN e.edit = 'I' THEN '' ELSE j.text END AS text, j.role,
    max(CASE WHEN e.edit = 'K' AND e.written = 1 AND j.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS system
  FROM edits e LEFT JOIN judged j ON e.conv_id IS NOT DISTINCT FROM j.conv_id AND e.k = j.k
), repaired AS (
  SELECT conv_id, string_agg(
    CASE WHEN edit = 'K' THEN role WHEN (written - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i
  ) FILTER (WHERE edit <> 'D') AS whole
  FROM joined GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE odd) AS illegal
  FROM judged GROUP BY conv_id
)
SELECT c.conv_id, coalesce(n.gaps, 0) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate,
  coalesce(n.truncated, 0) AS truncated, coalesce(n.illegal, 0) AS illegal, coalesce(a.cost, 0) AS cost, coalesce(a.audit, '') AS audit,
  sha256(coalesce(r.whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts n ON c.conv_id IS NOT DISTINCT FROM n.conv_id
LEFT JOIN audits a ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN repaired r ON c.conv_id IS NOT DISTINCT FROM r.conv_id
"""
