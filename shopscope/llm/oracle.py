"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP2 = r"""
WITH rules(host, path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), urls AS (
  SELECT page_id, url,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), fits AS (
  SELECT u.page_id, u.url, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
         max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM urls u JOIN rules r
    ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY u.page_id, u.url
)
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM urls u LEFT JOIN fits f USING (page_id, url)
"""

OP4 = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents
), g AS (
  SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY h
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256
FROM t JOIN g USING (h)
"""

# Copies of a document: integer boundaries between the scaled places i - 1 and i.
OP9 = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR),
                'n:' || coalesce(source, '') || chr(31) || CAST(size AS VARCHAR))), 1, 8) AS BIGINT)
           % greatest(1, CAST(ceil((SELECT count(*) FROM documents) / 16384.0) AS BIGINT)) AS cell
  FROM documents
), per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS w
  FROM sized GROUP BY source
), filling(round, capped, free_words, free_weight) AS (
  -- Sources whose share is above their cap leave the sharing, until none is.
  SELECT 0, [] :: VARCHAR[], CAST(sum(source_size) AS BIGINT), CAST(sum(w) AS BIGINT) FROM per_source
  UNION ALL
  SELECT round + 1, list_concat(capped, over.names), free_words - over.words, free_weight - over.weights
  FROM filling, LATERAL (
    SELECT list(coalesce('s' || source, 'n')) AS names, CAST(sum(3 * source_size) AS BIGINT) AS words,
           CAST(sum(w) AS BIGINT) AS weights
    FROM per_source
    WHERE NOT list_contains(capped, coalesce('s' || source, 'n'))
      AND CAST(w AS HUGEINT) * free_words > CAST(3 * source_size AS HUGEINT) * free_weight
  ) over WHERE over.names IS NOT NULL
), settled AS (
  SELECT * FROM filling ORDER BY round DESC LIMIT 1
), targets AS (
  SELECT source, source_size, coalesce('s' || source, 'n') AS sk,
         CASE WHEN list_contains(capped, coalesce('s' || source, 'n')) THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(w * free_words AS DOUBLE) / CAST(free_weight AS DOUBLE) END AS target
  FROM per_source, settled
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         (CAST('0x' || substr(md5('mix-1:' || t.sk), 1, 8) AS BIGINT) + 0.5 :: DOUBLE) / 4294967296.0 :: DOUBLE AS shift,
         row_number() OVER (PARTITION BY t.sk ORDER BY s.cell, s.size, s.doc_id NULLS LAST) AS i
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST((floor(i * rate + shift) - floor((i - 1) * rate + shift)) * size AS BIGINT) AS taken
FROM placed
"""

OP11 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL
), sizes AS (
  SELECT d, doc_id, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0
), totals AS (
  SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nl FROM sizes
), tf AS (
  SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM docs) GROUP BY d, term
), df AS (
  SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, totals GROUP BY term, nd
), items AS (
  SELECT item_id, text, term, count(*) AS times FROM (
    SELECT item_id, text, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
  ) GROUP BY item_id, text, term
), scores AS (
  SELECT i.item_id, i.text, s.d, s.doc_id,
         CAST(sum(i.times * df.w * ((1000000000 * tf.tf)
              // (1000 * tf.tf + 12 * (75 + (25 * s.n * nd) // nl)))) AS BIGINT) AS score
  FROM items i JOIN df USING (term) JOIN tf USING (term) JOIN sizes s USING (d), totals
  GROUP BY i.item_id, i.text, s.d, s.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), n AS (
  SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM words GROUP BY lang
), grams AS (
  SELECT lang, k, w[i : i + k - 1] AS p FROM (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 6) AS t(k)
  )
), f AS (
  SELECT lang, k, p, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY lang, k, p HAVING count(*) >= 100
), cuts AS (
  SELECT c.lang, c.p, c.f AS a, cut, l.f AS l, r.f AS r, n.n, (1000 * c.f * n.n) // (l.f * r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k >= 2) c
  JOIN f l ON l.lang = c.lang AND l.p = c.p[1 : cut]
  JOIN f r ON r.lang = c.lang AND r.p = c.p[cut + 1 : c.k]
  JOIN n ON n.lang = c.lang
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1
), inner_parts AS (
  SELECT lang, p[b : b + s - 1] AS p, max(f) AS longer FROM (
    SELECT lang, p, f, s, unnest(range(1, k - s + 2)) AS b FROM f, range(2, 5) AS t(s) WHERE s < k
  ) GROUP BY ALL
), kept AS (
  SELECT b.*, array_to_string(b.p, ' ') AS phrase
  FROM best b LEFT JOIN inner_parts i ON i.lang = b.lang AND i.p = b.p
  WHERE i.longer IS NULL OR 100 * i.longer < 100 * b.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""

ORACLE_SQL = {"op2_url_filter": OP2, "op4_exact_dedup": OP4, "op9_mixing": OP9, "op11_lexical": OP11,
              "op13_phrases": OP13}
