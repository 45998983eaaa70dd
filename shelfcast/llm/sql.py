"""DuckDB SQL for the operators that SQL can express (compared as text, no digests).

The rank ends in a text digest only to part rows that share a ``doc_id``; ids are
unique in the test tables, so the SQL ranks by id and position.
"""

from shelfcast.llm.substring_dedup import MIN_RUN_WORDS

BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH raw AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), numbered AS (
  SELECT doc_id, i, trim(lines[i + 1], {BLANK}) AS x
  FROM raw, unnest(range(len(lines))) AS r(i)
), worded AS (
  SELECT doc_id, i, x, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS w FROM numbered WHERE x <> ''
), win AS (
  SELECT a.doc_id, a.w, [a.x, b.x, c.x] AS k, a.i AS i0, b.i AS i1, c.i AS i2
  FROM worded a JOIN worded b ON a.doc_id = b.doc_id AND b.w = a.w + 1
  JOIN worded c ON a.doc_id = c.doc_id AND c.w = a.w + 2
), ranked AS (
  SELECT *, first_value(doc_id) OVER o AS fd, first_value(w) OVER o AS fw, row_number() OVER o AS rn
  FROM win WINDOW o AS (PARTITION BY k ORDER BY doc_id, w)
), gone AS (
  SELECT DISTINCT doc_id, i FROM (
    SELECT doc_id, w, fd, fw, rn, unnest([i0, i1, i2]) AS i, unnest([0, 1, 2]) AS j FROM ranked
  ) WHERE rn > 1 AND (doc_id <> fd OR w + j > fw + 2)
), lists AS (SELECT doc_id, list(i) AS l FROM gone GROUP BY doc_id)
SELECT raw.doc_id,
  CASE WHEN l IS NULL THEN text
       ELSE coalesce(array_to_string([lines[i + 1] FOR i IN range(len(lines)) IF NOT list_contains(l, i)], chr(10)), '')
  END AS text,
  CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(l), 0) AS BIGINT) AS n_removed
FROM raw LEFT JOIN lists USING (doc_id)
"""

SUBSTRING_DEDUP = f"""
WITH raw AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), units AS (
  SELECT doc_id, u, lines[u + 1] AS x,
    coalesce(list_sum([length(lines[v + 1]) + 1 FOR v IN range(u)]), 0) AS start,
    [w FOR w IN string_split_regex(trim(lines[u + 1], {BLANK}), '[\\x20\\x09-\\x0D]+') IF w <> ''] AS words
  FROM raw, unnest(range(len(lines))) AS r(u)
), worded AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY u) AS w,
    row_number() OVER (PARTITION BY lower(array_to_string(words, ' ')) ORDER BY doc_id, u) AS rn
  FROM units WHERE len(words) > 0
), repeats AS (
  SELECT *, w - row_number() OVER (PARTITION BY doc_id ORDER BY u) AS run FROM worded WHERE rn > 1
), passages AS (
  SELECT *, sum(len(words)) OVER (PARTITION BY doc_id, run) AS run_words FROM repeats
), gone AS (
  SELECT doc_id, list(u) AS l,
    '[' || string_agg('{{"start":' || CAST(start AS BIGINT) || ',"length":' || length(x) || '}}', ',' ORDER BY u) || ']' AS spans
  FROM passages WHERE run_words >= {MIN_RUN_WORDS} GROUP BY doc_id
)
SELECT raw.doc_id,
  CASE WHEN l IS NULL THEN text
       ELSE coalesce(array_to_string([lines[u + 1] FOR u IN range(len(lines)) IF NOT list_contains(l, u)], chr(10)), '')
  END AS text,
  CAST(coalesce(len(lines), 0) AS BIGINT) AS n_units, CAST(coalesce(len(l), 0) AS BIGINT) AS n_removed,
  coalesce(spans, '[]') AS spans
FROM raw LEFT JOIN gone USING (doc_id)
"""

_WORDS = """[w FOR w IN string_split_regex(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF w <> '']"""

DECONTAMINATION = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents
), b AS (
  SELECT item_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM benchmark
), pat AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, w[i + 1 : i + 10] AS p
  FROM b, unnest(range(greatest(len(w) - 9, 1))) AS t(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT len(p) AS k FROM pat
), win AS (
  SELECT r, i, k, w[i + 1 : i + k] AS p FROM d, sizes, unnest(range(len(w) - k + 1)) AS t(i)
), occ AS (
  SELECT r, i, k, item FROM win JOIN pat USING (p)
), hit AS (
  SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM occ) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT r, item FROM occ) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""
