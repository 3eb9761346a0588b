"""DuckDB forms of the queries that SQL can express."""

CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(role) + 1 + length(CASE WHEN regexp_matches(text, '<\|im_(start|end)\|>|<\\+\|') THEN regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') ELSE text END) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars,
  true AS round_trip
FROM turns GROUP BY conv_id
"""

QUALITY_SQL = r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
judged AS (
  SELECT w.doc_id, w.source, len(w.w) AS n_words, CAST(coalesce(list_sum(list_transform(w.w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    len(regexp_extract_all(w.text, '[#*$%&|<>]')) AS n_symbols, len(l.l) AS n_lines, len(l.l) - len(list_distinct(l.l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM w JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)),
ruled AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, 10 * n_symbols > n_words AS b1, 10 * n_dup_lines > 3 * n_lines AS b2,
    word_chars < 2 * n_words OR word_chars > 15 * n_words AS b3 FROM judged),
hosts AS (
  SELECT source, count(*) AS n, sum(b1::INT) AS f1, sum(b2::INT) AS f2, sum(b3::INT) AS f3, sum((base_failed OR b1 OR b2 OR b3)::INT) AS f4 FROM ruled GROUP BY source),
long AS (SELECT source, n, unnest([1, 2, 3, 4]) AS r, unnest([f1, f2, f3, f4]) AS f FROM hosts),
moments AS (
  SELECT r, sum(n) AS rows, sum(n * n) AS squares, count(*) AS hosts, least(greatest(sum(f) / sum(n), 1e-6), 1 - 1e-6) AS m, sum(f * f / n) AS q FROM long GROUP BY r),
prior AS (
  SELECT r, m, greatest(m * (1 - m) / greatest((q - rows * m * m - m * (1 - m) * (hosts - 1)) / greatest(rows - squares / rows, 1.0), m * (1 - m) * 1e-4) - 1, 1.0) AS k FROM moments),
rates AS (SELECT source, r, m, n + k + 1 AS total, (f + m * k) / (n + k) AS rate FROM long JOIN prior USING (r)),
verdicts AS (SELECT source, r, rate > 0.5 AS high, rate + 1.645 * sqrt(rate * (1 - rate) / total) < m AS low FROM rates),
wide AS (SELECT source, bool_or(low) FILTER (r = 1) AS w1, bool_or(low) FILTER (r = 2) AS w2, bool_or(low) FILTER (r = 3) AS w3, bool_or(high) FILTER (r = 4) AS condemned FROM verdicts GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT condemned AND NOT ((b1 AND NOT w1) OR (b2 AND NOT w2) OR (b3 AND NOT w3)) AS kept
FROM ruled JOIN wide ON ruled.source IS NOT DISTINCT FROM wide.source
"""

JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(CASE WHEN len(w) >= 5 THEN range(1, len(w) - 3) WHEN len(w) > 0 THEN [1] ELSE [] END) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
least_id AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.m AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN least_id m ON m.a = d.doc_id
"""

CONTAIN_SQL = r"""
WITH texts AS (SELECT true AS doc, doc_id AS id, text FROM documents UNION ALL SELECT false, item_id, text FROM benchmark),
w AS (
  SELECT doc, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM texts),
s AS (
  SELECT DISTINCT doc, id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc, id, w, unnest(CASE WHEN len(w) >= 5 THEN range(1, len(w) - 3) WHEN len(w) > 0 THEN [1] ELSE [] END) AS i FROM w)),
n AS (SELECT id, count(*) AS n FROM s WHERE NOT doc GROUP BY id),
pairs AS (SELECT a.id AS doc_id, b.id AS item_id, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc AND NOT b.doc GROUP BY ALL)
SELECT doc_id, item_id, n AS n_item_shingles, c AS n_shared, c / n AS containment FROM pairs JOIN n ON item_id = n.id WHERE 10 * c >= 8 * n
"""

#: Sentences keep the white space after them; U+E000 marks where one begins.
SPANS_SQL = r"""
WITH d AS (SELECT doc_id, text, regexp_extract(coalesce(text, ''), '^[\x20\x09-\x0D]*') AS lead FROM documents),
p AS (
  SELECT doc_id, text, lead, list_filter(string_split(regexp_replace(substr(coalesce(text, ''), length(lead) + 1),
    '([.!?][\x20\x09-\x0D]+|[\x20\x09\x0B-\x0D]*\x0A[\x20\x09-\x0D]*)', '\1' || chr(57344), 'g'), chr(57344)), lambda x: x <> '') AS p FROM d),
w AS (
  SELECT doc_id, list_transform(p, lambda x: array_to_string(regexp_extract_all(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' ')) AS s,
    list_transform(p, lambda x: len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))) AS n FROM p WHERE doc_id IS NOT NULL),
places AS (SELECT doc_id, s, n, i, unnest(range(1, least(10, len(s) - i + 1) + 1)) AS k FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM w)),
sized AS (SELECT doc_id, s, i, k, list_sum(n[i:i + k - 1]) AS words, n[i] AS first_words, n[i + k - 1] AS last_words FROM places),
runs AS (
  SELECT doc_id, i, k, array_to_string(s[i:i + k - 1], chr(10)) AS g FROM sized
  WHERE (k = 1 AND words >= 32) OR (k = 2 AND words >= 20) OR (k = 3 AND words >= 10) OR (k > 3 AND words >= 10 AND (words - last_words < 10 OR words - first_words < 10))),
later AS (SELECT doc_id, i, k FROM (SELECT *, dense_rank() OVER (PARTITION BY k, g ORDER BY doc_id, i) AS nth FROM runs) WHERE nth > 1),
gone AS (SELECT doc_id, list(DISTINCT place) AS gone FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM later) GROUP BY doc_id)
SELECT p.doc_id, len(p.p) AS n_sentences, coalesce(len(gone), 0) AS n_removed,
  CASE WHEN gone IS NULL THEN text ELSE lead || array_to_string(list_filter(p.p, lambda x, i: NOT list_contains(gone, i)), '') END AS text
FROM p LEFT JOIN gone USING (doc_id)
"""
