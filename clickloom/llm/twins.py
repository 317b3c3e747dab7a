"""DuckDB twins of the operators that SQL can express, written from their definitions."""

from __future__ import annotations

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Everything an id reaches over links (u, w), itself included; ``ids`` has all ids.
REACH = """reach AS (
  SELECT id AS s, id AS t FROM ids UNION SELECT r.s, l.w FROM reach r JOIN links l ON l.u = r.t),
parts AS (SELECT s AS id, min(t) AS component_id FROM reach GROUP BY s)"""

EMBEDDINGS = f"""
WITH RECURSIVE ids AS (SELECT DISTINCT vec_id AS id FROM embeddings),
v AS (
  SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.id AS u, b.id AS w FROM v a JOIN v b ON a.label = b.label AND a.id <> b.id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
{REACH},
counted AS (SELECT u AS id, count(DISTINCT w) AS n FROM links GROUP BY u)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept
FROM ids JOIN parts USING (id) LEFT JOIN counted USING (id)
"""

WORD_WINDOWS = f"""
WITH docs AS (SELECT doc_id, coalesce({WORDS.format(text="text")}, []) AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM docs),
windows AS (
  SELECT doc_id, p, CASE WHEN p + 19 <= len(words) THEN array_to_string(words[p:p + 19], ' ') END AS w, words[p] AS word FROM places),
starts AS (
  SELECT doc_id, p, word, w IS NOT NULL AND row_number() OVER (PARTITION BY w ORDER BY doc_id, p) > 1 AS again FROM windows),
covered AS (
  SELECT doc_id, p, word, coalesce(bool_or(again) OVER (PARTITION BY doc_id ORDER BY p ROWS 19 PRECEDING), false) AS gone FROM starts),
sums AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone), '') AS kept
  FROM covered GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN sums USING (doc_id)
"""

MINHASH = f"""
WITH RECURSIVE docs AS (SELECT doc_id AS id, coalesce({WORDS.format(text=LOWERED)}, []) AS words FROM documents),
ids AS (SELECT id FROM docs),
shingles AS (
  SELECT DISTINCT id, array_to_string(words[p:p + 2], ' ') AS s FROM (
    SELECT id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS p FROM docs WHERE len(words) > 0)),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
common AS (SELECT a.id AS u, b.id AS w, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.id <> b.id GROUP BY ALL),
links AS (
  SELECT u, w FROM common JOIN sizes x ON x.id = u JOIN sizes y ON y.id = w WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
{REACH}
SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, id = component_id AS kept
FROM ids JOIN parts USING (id) LEFT JOIN sizes USING (id)
"""

BYTE_WINDOWS = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
places AS (SELECT doc_id, x, unnest(range(0, length(x) // 2)) AS p FROM docs),
windows AS (
  SELECT doc_id, p, CASE WHEN 2 * p + 200 <= length(x) THEN substring(x, 2 * p + 1, 200) END AS w, substring(x, 2 * p + 1, 2) AS b FROM places),
starts AS (
  SELECT doc_id, p, b, w IS NOT NULL AND row_number() OVER (PARTITION BY w ORDER BY doc_id, p) > 1 AS again FROM windows),
covered AS (
  SELECT doc_id, p, b, coalesce(bool_or(again) OVER (PARTITION BY doc_id ORDER BY p ROWS 99 PRECEDING), false) AS gone FROM starts),
edges AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS opens FROM covered),
sums AS (
  SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
    coalesce(string_agg(b, '' ORDER BY p) FILTER (WHERE NOT gone), '') AS kept
  FROM edges GROUP BY doc_id)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM docs LEFT JOIN sums USING (doc_id)
"""

LEXICAL_SEARCH = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY doc_id),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS l FROM sizes),
ms AS (SELECT doc_id, 100 - 90 + (90 * n * n_docs) // l AS m FROM sizes, totals),
ws AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tfs, totals GROUP BY term, n_docs),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN ws USING (term) JOIN tfs USING (term) JOIN ms USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10"""
