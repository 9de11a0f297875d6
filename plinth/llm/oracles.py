"""SQL for the operators on word windows, straight from what they are to return."""

from __future__ import annotations

#: Words are unchanged runs of characters other than white space; `row` tells rows that share an id apart.
_WORDS = r"""
docs AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({text}, '[^\x20\x09-\x0D]+') AS words FROM documents),
words AS (SELECT row, doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM docs)"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8_SQL = f"""
WITH RECURSIVE {_WORDS.format(text=_LOWER)},
grams AS (
  SELECT row, word || ' ' || lead(word, 1) OVER along || ' ' || lead(word, 2) OVER along AS gram
  FROM words WINDOW along AS (PARTITION BY row ORDER BY pos)),
shingles AS (
  SELECT DISTINCT row, gram FROM grams WHERE gram IS NOT NULL
  UNION ALL SELECT row, array_to_string(words, ' ') FROM docs WHERE len(words) BETWEEN 1 AND 2),
sizes AS (SELECT row, count(*) AS n FROM shingles GROUP BY row),
common AS (
  SELECT a.row AS u, b.row AS v, count(*) AS n FROM shingles a JOIN shingles b ON a.gram = b.gram AND a.row < b.row GROUP BY a.row, b.row),
links AS (
  SELECT u, v FROM common c JOIN sizes s ON c.u = s.row JOIN sizes t ON c.v = t.row WHERE 100 * c.n >= 90 * (s.n + t.n - c.n)),
edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reached(row, other) AS (
  SELECT row, row FROM docs
  UNION SELECT r.row, e.v FROM reached r JOIN edges e ON r.other = e.u)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(o.doc_id)::BIGINT AS component_id
FROM docs d JOIN reached r ON d.row = r.row JOIN docs o ON r.other = o.row LEFT JOIN sizes s ON d.row = s.row
GROUP BY d.row, d.doc_id
"""

OP10_SQL = f"""
WITH {_WORDS.format(text="coalesce(text, '')")},
windows AS (
  SELECT row, doc_id, word, pos,
         CASE WHEN count(*) OVER ahead = 50 THEN sha256(string_agg(word, ' ') OVER ahead) END AS key
  FROM words WINDOW ahead AS (PARTITION BY row ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
starts AS (
  SELECT row, word, pos, key IS NOT NULL AND min(doc_id) OVER (PARTITION BY key) < coalesce(doc_id, 9223372036854775807) AS again FROM windows),
covered AS (
  SELECT row, word, pos, coalesce(bool_or(again) OVER (PARTITION BY row ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), FALSE) AS gone FROM starts),
kept AS (
  SELECT row, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS text
  FROM covered GROUP BY row)
SELECT d.doc_id, coalesce(k.n_words, 0)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.row = k.row
"""
