"""DuckDB SQL for the operators that SQL can express, over the same whole tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op4_quality_rules"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
win AS (
  SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
hit AS (
  SELECT rid, i FROM win
  QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1),
cover AS (
  SELECT rid, count(DISTINCT i + k) AS n
  FROM hit, (VALUES (0), (1), (2)) AS o(k) GROUP BY rid),
line AS (
  SELECT rid, j, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
         length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) AS chars
  FROM (SELECT rid, ls[j] AS l, j
        FROM (SELECT rid, ls, unnest(range(1, len(ls) + 1)) AS j
              FROM (SELECT rid, string_split(t, chr(10)) AS ls FROM d)))),
judged AS (
  SELECT rid, l, n, chars, n > 0 AND (
      (len(regexp_extract_all(l, '\|')) >= 3 AND len(regexp_extract_all(l, '\|')) * 5 >= n)
      OR len(regexp_extract_all(l, '[#*$%&|<>]')) * 10 > n * 3
      OR (len(regexp_extract_all(l, '!!')) >= 3 AND len(regexp_extract_all(l, '!!')) * 2 >= n)
      OR (n >= 10 AND NOT regexp_matches(l, '[.!?。！？…:;]'))
      OR (n <= 40 AND regexp_matches(lower(l), 'licensed under|all rights reserved|copyright|©|cookie policy|privacy policy|terms of use|terms of service|enable javascript|subscribe to our|click here|lorem ipsum|sign up for'))
    ) AS bad
  FROM line),
per_line AS (
  SELECT rid, count(*) FILTER (n > 0) - count(DISTINCT l) FILTER (n > 0) AS dup,
         count(*) FILTER (bad) AS removed, coalesce(sum(chars) FILTER (bad), 0) AS lost
  FROM judged GROUP BY rid),
f AS (
  SELECT w.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         dup::BIGINT AS n_dup_lines, coalesce(cover.n, 0)::BIGINT AS n_repeat_words,
         removed::BIGINT AS n_removed_lines, lost::BIGINT AS n_lost_chars
  FROM w JOIN per_line USING (rid) LEFT JOIN cover USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND 100 * n_lost_chars <= 50 * word_chars AS kept,
       n_removed_lines, n_lost_chars
FROM f
"""

ORACLE["op10_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (
  SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (
  SELECT *, CASE WHEN payload_bytes >= 1000
            THEN max(page_id) OVER (PARTITION BY payload_digest) END AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN last > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last > page_id THEN last END AS refers_to
FROM m
"""

ORACLE["op13_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
tok AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM tok GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
v AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM tok SEMI JOIN kept USING (lang, term) GROUP BY ALL),
tot AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total
  FROM grp g LEFT JOIN c USING (lang, source) GROUP BY ALL),
full_p AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (t.total + v.v) AS p
  FROM tot t JOIN v USING (lang) JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
whole AS (
  SELECT lang, term, 1 + (1000000000 * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v) AS q
  FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY ALL) JOIN v USING (lang)),
lead AS (
  SELECT f.lang, f.source, f.term AS item, (f.p - w.q) * (f.p - w.q) // w.q AS value
  FROM full_p f JOIN whole w USING (lang, term) WHERE f.n > 0 AND f.p > w.q),
pair_sum AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM full_p a JOIN full_p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sum s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, 'pair' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
  UNION ALL BY NAME
  SELECT *, 'term' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM lead
  QUALIFY rank <= 200)
"""
