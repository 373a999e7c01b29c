"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

OP9 = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT norm, count(*) AS group_size,
         first(doc_id ORDER BY length(text) DESC, doc_id) AS keep_id
  FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept,
       sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""

_WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP3 = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                    '{_WORDS}') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                     '{_WORDS}') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS n,
               unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, s, n, item_id FROM dw JOIN bw USING (win, n)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS p
              FROM (SELECT DISTINCT doc_id, s, n FROM hit)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items,
               string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP1 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM w
        WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 75 * (x.n + y.n - k)),
both_ways AS MATERIALIZED (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (
  SELECT doc_id, doc_id AS other FROM n
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON e.a = r.other),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id,
       coalesce(component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

OP4 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n
  FROM pages),
f AS (SELECT html, min(page_id) AS first_id FROM p GROUP BY html)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN f USING (html)
"""

OP13 = f"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                   '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM piece),
gram AS (
  SELECT lang, size, w[i:i + size - 1] AS w
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM w, range(1, 6) AS sizes(size) WHERE len(w) >= size)),
f AS MATERIALIZED (
  SELECT lang, size, array_to_string(w, ' ') AS phrase, first(w) AS w, count(*) AS f
  FROM gram GROUP BY lang, size, phrase),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, phrase, w, size, f AS a FROM f WHERE size > 1 AND f >= 100),
cut AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
scored AS (
  SELECT cut.lang, cut.phrase, a, x.f AS l, y.f AS r, n, k,
         CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = head
           JOIN f y ON y.lang = cut.lang AND y.phrase = tail JOIN n ON n.lang = cut.lang),
lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored)
  WHERE nth = 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer
  FROM (SELECT lang, a, array_to_string(w[i:i + s - 1], ' ') AS phrase
        FROM (SELECT lang, a, w, s, unnest(range(1, size - s + 2)) AS i
              FROM (SELECT *, unnest(range(2, size)) AS s FROM c))) GROUP BY lang, phrase),
ranked AS (
  SELECT lowest.lang, lowest.phrase, a, l, r, n, score,
         row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, lowest.phrase) AS rank
  FROM lowest LEFT JOIN inside ON inside.lang = lowest.lang AND inside.phrase = lowest.phrase
  WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

SQL = {"op13_collocations": OP13,
       "op1_near_duplicates": OP1,
       "op4_warc": OP4,
       "op3_decontaminate": OP3,
       "op9_exact_dedup": OP9}
