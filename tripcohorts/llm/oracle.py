"""DuckDB statements for the operators that SQL can express on whole tables.

The others hash bytes, use tokenizers or trained models, or compare every window of a text; they
are tested against plain versions on small tables.
"""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS shingle
  FROM words, unnest(range(1, greatest(len(w) - 1, least(len(w), 1) + 1))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 85 * (p.n + q.n - c)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(x, y) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reached.x, ways.y FROM reached JOIN ways ON reached.y = ways.x)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, r.least AS component_id, d.doc_id = r.least AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS least FROM reached GROUP BY x) r USING (doc_id)
"""

QUALITY = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '{_WORD}') AS words FROM d),
runs AS (
  SELECT r, i, words[i : i + 7] AS run FROM w, unnest(range(1, len(words) - 6)) AS t(i) WHERE len(words) >= 8),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS c FROM runs) WHERE c > 1),
repeated AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, unnest(range(0, 8)) AS t(k) GROUP BY r),
lines AS (
  SELECT r, host, line, regexp_extract_all(line, '{_WORD}') AS words
  FROM (SELECT r, host, unnest(string_split(t, chr(10))) AS line FROM d)),
spoken AS (
  SELECT r, host, line, len(words) AS n, {_LOWER.format("array_to_string(words, ' ')")} AS plain
  FROM lines WHERE len(words) > 0),
doubled AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM spoken GROUP BY r),
firsts AS (SELECT min(r) AS r, host FROM d GROUP BY host, t),
hosts AS (SELECT host, count(*) AS texts FROM firsts GROUP BY host),
counted AS (
  SELECT host, plain, count(*) AS texts
  FROM (SELECT DISTINCT r, host, plain FROM spoken WHERE r IN (SELECT r FROM firsts)) GROUP BY host, plain),
frequent AS (
  SELECT counted.host, plain FROM counted JOIN hosts ON counted.host = hosts.host
  WHERE 100 * counted.texts > least(greatest(2 * hosts.texts, 2000), 100000)),
removed AS (
  SELECT r, sum(n) AS n FROM spoken JOIN frequent ON spoken.host = frequent.host AND spoken.plain = frequent.plain
  GROUP BY r),
measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(doubled.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(removed.n, 0) AS BIGINT) AS removed_words
  FROM d JOIN w USING (r) LEFT JOIN doubled USING (r) LEFT JOIN repeated USING (r) LEFT JOIN removed USING (r)),
failed AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT *, NOT base_failed AND NOT (removed_words > 0 AND n_words - removed_words < 0.3 * n_words) AS kept FROM failed
"""
