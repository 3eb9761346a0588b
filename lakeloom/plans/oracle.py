"""DuckDB forms of the queries, over the same tables."""

from __future__ import annotations

from lakeloom.functions.text import STOP_TOKENS, SUFFIX_PATTERN, TITLE_PATTERN

_DOCS = "docs AS (SELECT doc_id, '/data/' || source || '/' || lang || '/doc_' || doc_id || '.txt' AS base_path, coalesce(text, '') AS text FROM documents)"
_VARIANTS = f"""{_DOCS}, x AS (SELECT base_path, text FROM docs UNION ALL
  SELECT base_path || '.copy', ' ' || replace(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), ' ', '  ') FROM docs WHERE doc_id % 10 = 0)"""
_CHUNKS = f"""{_DOCS}, lines AS (SELECT doc_id, base_path, string_split(text, chr(10)) AS l FROM docs),
starts AS (SELECT doc_id, base_path, l, unnest(range(0, len(l), 15)) AS i FROM lines),
windows AS (SELECT doc_id, base_path, i // 15 AS chunk_index, array_to_string(l[i + 1:i + 20], chr(10)) AS text FROM starts),
chunks AS (SELECT doc_id * 10000000 + chunk_index AS chunk_id, base_path AS source_path, base_path || '_' || chunk_index AS filename, CAST(chunk_index AS INT) AS chunk_index, text, length(text) // 4 AS token_count
  FROM windows WHERE regexp_matches(text, '\\S'))"""
_ENTITIES = """entities AS (
  SELECT min(p_partkey) AS entity_id, p_name AS name, p_type AS type, min(p_brand) AS description, CAST(min(l_orderkey) AS VARCHAR) AS first_seen_document, list_sort(list(DISTINCT CAST(l_orderkey AS VARCHAR))) AS documents_appeared
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name, p_type
  UNION ALL SELECT min(s_suppkey) + 10000000, s_name, 'supplier', NULL, CAST(min(l_orderkey) AS VARCHAR), list_sort(list(DISTINCT CAST(l_orderkey AS VARCHAR)))
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name)"""
_RELS = """rels AS (
  SELECT l_orderkey * 8 + l_linenumber AS relationship_id, s_name AS source, p_name AS target, l_returnflag AS type, l_linestatus AS description, CAST(l_orderkey AS VARCHAR) AS document_id
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""
_LETTERS = """letters AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS document_id, c_name AS sender, 'small ring' || CASE WHEN o_orderkey % 2 = 0 THEN ' Inc.' ELSE '' END AS recipient, o_orderpriority AS subject, o_orderstatus AS reference
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def _hashed(kind: str, source: str, value: str) -> str:
    return f"""{kind}_h AS (SELECT base_path, sha256({value}) AS content_hash FROM {source}),
{kind}_g AS (SELECT base_path, '{kind}' AS hash_type, content_hash, min(base_path) OVER (PARTITION BY content_hash) AS first_path, count(*) OVER (PARTITION BY content_hash) AS n FROM {kind}_h),
{kind} AS (SELECT base_path, hash_type, content_hash, first_path FROM {kind}_g WHERE n > 1)"""


_NORMAL = "regexp_replace(regexp_replace(lower(text), '\\s+', ' ', 'g'), '^ | $', '', 'g')"


def _groups(source: str) -> str:
    return f"""{_hashed('exact', source, 'text')}, rest AS (SELECT * FROM {source} WHERE base_path NOT IN (SELECT base_path FROM exact)),
{_hashed('normalized', 'rest', _NORMAL)}, grp AS (SELECT * FROM exact UNION ALL SELECT * FROM normalized)"""


_PRIME = 2147483647


def _signatures(source: str) -> str:
    """Long form (base_path, slot, value), and bands."""
    return f"""ws AS (SELECT base_path, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS w FROM {source}),
grams AS (SELECT base_path, unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN list_distinct(w) ELSE [''] END) AS g FROM ws),
hashes AS (SELECT base_path, CAST('0x' || substr(md5(g), 1, 8) AS BIGINT) % {_PRIME} AS h FROM grams),
slots AS (SELECT i AS slot, (1103515245 * (i + 1) + 12345) % {_PRIME} AS a, (1664525 * (i + 1) * (i + 1) + 1013904223) % {_PRIME} AS b FROM (SELECT unnest(range(128)) AS i)),
sig AS (SELECT base_path, slot, min((a * h + b) % {_PRIME}) AS value FROM hashes, slots GROUP BY base_path, slot)"""


_PAIRS = f"""{_DOCS}, x AS (SELECT base_path, text FROM docs), {_groups('x')},
kept AS (SELECT * FROM x WHERE base_path NOT IN (SELECT base_path FROM grp WHERE base_path <> first_path)), {_signatures('kept')},
whole AS (SELECT base_path, list(value ORDER BY slot) AS s FROM sig GROUP BY base_path),
firsts AS (SELECT s, min(base_path) AS path FROM whole GROUP BY s),
bands AS (SELECT path, s, unnest(range(14)) AS band FROM firsts),
keyed AS (SELECT path, band, s[band * 9 + 1:band * 9 + 9] AS key FROM bands),
met AS (SELECT DISTINCT a.path AS path_a, b.path AS path_b FROM keyed a JOIN keyed b ON a.band = b.band AND a.key = b.key AND a.path < b.path),
pairs AS (
  SELECT path_a, path_b, len(list_filter(list_zip(x.s, y.s), lambda z: z[1] = z[2])) / 128 AS jaccard_est
  FROM met JOIN firsts x ON x.path = path_a JOIN firsts y ON y.path = path_b
  UNION ALL SELECT path, base_path, 1.0 FROM whole JOIN firsts USING (s) WHERE base_path <> path)"""
_DEGREES = f"{_PAIRS}, deg AS (SELECT base_path, count(*) AS pair_count FROM (SELECT path_a AS base_path FROM pairs UNION ALL SELECT path_b FROM pairs) GROUP BY base_path)"


def _reach(links: str) -> str:
    """Components of (src, dst) links: (node, component)."""
    return f"""both_ways AS (SELECT src, dst FROM ({links}) UNION SELECT dst, src FROM ({links})),
reach(a, b) AS (SELECT src, src FROM both_ways UNION SELECT r.a, e.dst FROM reach r JOIN both_ways e ON r.b = e.src),
found AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a)"""


_MANIFEST = f"""{_PAIRS}, {_reach('SELECT first_path AS src, base_path AS dst FROM grp UNION ALL SELECT path_a, path_b FROM pairs')},
clustered AS (SELECT base_path, coalesce(component, base_path) AS cluster FROM x LEFT JOIN found ON node = base_path),
ranked AS (SELECT *, first_value(base_path) OVER (PARTITION BY cluster ORDER BY length(base_path), base_path) AS rep FROM clustered),
manifest AS (SELECT base_path, cluster, base_path = rep AS is_representative, CASE WHEN base_path <> rep THEN rep END AS duplicate_of,
  CASE WHEN base_path IN (SELECT base_path FROM grp) THEN 'hash' WHEN base_path IN (SELECT path_a FROM pairs UNION SELECT path_b FROM pairs) THEN 'lsh' END AS source FROM ranked)"""

_JSON = """replies AS (
  SELECT doc_id AS chunk_id, source, lang, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z]+', ' ', 'g')), ' ') AS w FROM documents),
said AS (
  SELECT chunk_id, source, lang, coalesce(w[1], 'none') AS n1, coalesce(w[2], 'none') AS n2, coalesce(w[3], 'none') AS n3, chunk_id % 7 <> 0 AS readable FROM replies),
bodies AS (SELECT *, '{"metadata":{"sender":"' || source || '","recipient":["' || lang || '","","' || source || '"],"subject":null,"date":"2024-01-01"},"entities":[{"name":"' || n1 || '","type":"person","description":"about ' || n2
  || '"},{"name":" ' || n2 || ' ","type":"organization","description":null},{"name":"","type":"x","description":"y"}],"relationships":[{"source":"' || n1 || '","target":"' || n2 || '","type":"knows","description":"' || n3
  || '"},{"source":"' || n1 || '","target":"","type":"t","description":null}]}' AS body FROM said),
parsed AS (SELECT *, CASE WHEN readable THEN body ELSE 'Sorry, ' || body END AS bare, CASE WHEN readable THEN CAST(body AS JSON) END AS j FROM bodies),
mentions AS (SELECT chunk_id, i, trim(json_extract_string(e, '$.name')) AS name, trim(json_extract_string(e, '$.type')) AS type, trim(coalesce(json_extract_string(e, '$.description'), '')) AS description
  FROM (SELECT chunk_id, unnest(range(3)) AS i, unnest(from_json(j->'$.entities', '["JSON"]')) AS e FROM parsed WHERE readable)
  WHERE json_extract_string(e, '$.name') <> '' AND json_extract_string(e, '$.type') <> ''),
folded AS (SELECT name, type, arg_min(description, chunk_id * 10 + i) AS description, CAST(min(chunk_id) AS VARCHAR) AS first_seen_document, array_to_string(list_transform(list_sort(list(DISTINCT chunk_id)), lambda x: CAST(x AS VARCHAR)), '|') AS documents_appeared
  FROM mentions GROUP BY name, type),
facts AS (SELECT chunk_id, unnest(from_json(j->'$.relationships', '["JSON"]')) AS r FROM parsed WHERE readable),
rel AS (SELECT json_extract_string(r, '$.source') AS source, json_extract_string(r, '$.target') AS target, json_extract_string(r, '$.type') AS type, coalesce(json_extract_string(r, '$.description'), '') AS description, CAST(chunk_id AS VARCHAR) AS document_id
  FROM facts WHERE json_extract_string(r, '$.source') <> '' AND json_extract_string(r, '$.target') <> '' AND json_extract_string(r, '$.type') <> '')"""


def _key(name: str) -> str:
    x = f"lower(trim({name}))"
    for pattern, to, every in (
        (r"\s*\(.*?\)\s*", " ", "g"), (TITLE_PATTERN, "", ""), ("(?s)" + SUFFIX_PATTERN, r"\1", ""), (r"[^a-z0-9\s\-]", "", "g"), (r"\s*-\s*", "-", "g"), (r"\s+", " ", "g"), ("^ | $", "", "g"),
    ):
        x = f"regexp_replace({x}, '{pattern}', '{to}', '{every}')" if every else f"regexp_replace({x}, '{pattern}', '{to}')"
    return x


_MERGE = f"""{_ENTITIES}, keyed AS (SELECT *, CASE WHEN {_key('name')} = '' THEN lower(trim(name)) ELSE {_key('name')} END AS group_key, len(documents_appeared) AS n_docs FROM entities),
grouped AS (SELECT *, count(*) OVER (PARTITION BY group_key) AS group_size, row_number() OVER (PARTITION BY group_key ORDER BY n_docs DESC, length(name) DESC, entity_id) AS rank FROM keyed),
members AS (SELECT *, first_value(name) OVER (PARTITION BY group_key ORDER BY rank) AS canonical FROM grouped WHERE group_size > 1)"""
_MERGED = f"""{_MERGE}, heads AS (
  SELECT group_key, min(entity_id) AS first_id, max(name) FILTER (rank = 1) AS name, max(type) FILTER (rank = 1) AS type, arg_max(description, length(coalesce(description, '')) * 1000000 - rank) AS description,
    max(first_seen_document) FILTER (rank = 1) AS first_seen_document, list_sort(list_distinct(flatten(list(documents_appeared)))) AS documents_appeared FROM members GROUP BY group_key),
merged AS (
  SELECT entity_id, name, type, description, first_seen_document, documents_appeared FROM grouped WHERE group_size = 1
  UNION ALL SELECT (SELECT max(entity_id) FROM entities) + row_number() OVER (ORDER BY first_id), name, type, description, first_seen_document, documents_appeared FROM heads)"""
_STOP = "[" + ", ".join(f"'{t}'" for t in STOP_TOKENS) + "]"


def _blocked(source: str) -> str:
    """Scored pairs of names that share a blocking token."""
    return f"""names AS (SELECT DISTINCT name, {_key('name')} AS k FROM {source}),
tokens AS (SELECT DISTINCT name, k, unnest(list_filter(string_split(k, ' '), lambda t: length(t) >= 2 AND NOT list_contains({_STOP}, t))) AS token FROM names),
blocked AS (SELECT DISTINCT a.name AS name_a, b.name AS name_b, a.k AS key_a, b.k AS key_b FROM tokens a JOIN tokens b ON a.token = b.token AND a.name < b.name AND a.k <> b.k),
sorted AS (SELECT *, array_to_string(list_sort(string_split(key_a, ' ')), ' ') AS ta, array_to_string(list_sort(string_split(key_b, ' ')), ' ') AS tb FROM blocked),
lcs(name_a, name_b, ta, tb, i, row) AS (
  SELECT name_a, name_b, ta, tb, 0, list_transform(range(length(tb) + 1), lambda x: CAST(0 AS BIGINT)) FROM sorted
  UNION ALL SELECT name_a, name_b, ta, tb, i + 1,
    list_reduce(list_transform(range(1, length(tb) + 1), lambda j: [CAST(j AS BIGINT)]), lambda acc, j: list_append(acc, greatest(acc[len(acc)], row[j[1] + 1], CASE WHEN ta[i + 1] = tb[j[1]] THEN row[j[1]] + 1 ELSE 0 END)), [CAST(0 AS BIGINT)])
  FROM lcs WHERE i < length(ta)),
last_row AS (SELECT name_a, name_b, 2 * row[len(row)] / (length(ta) + length(tb)) AS ts FROM lcs WHERE i = length(ta)),
scored AS (SELECT name_a, name_b, round(jaro_winkler_similarity(key_a, key_b), 4) AS jw, round(ts, 4) AS ts, round(greatest(jaro_winkler_similarity(key_a, key_b), ts), 4) AS combined FROM blocked JOIN last_row USING (name_a, name_b))"""


_TOPK = """sims AS (
  SELECT a.vec_id AS i, b.vec_id AS j, list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS sim FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY sim DESC, j) AS rank FROM sims)"""
_NODES = f"""{_ENTITIES},
files AS (SELECT CAST(o_orderkey AS VARCHAR) AS chunk_id, 'I:/box' || (o_orderkey % 50) || '/letter.pdf' AS filename, CAST(o_orderkey % 7 + 1 AS VARCHAR) AS page FROM orders),
seen AS (SELECT entity_id, name, unnest(documents_appeared) AS chunk_id, unnest(range(len(documents_appeared))) AS nth FROM entities),
known AS (SELECT entity_id, name, nth, coalesce(filename, s.chunk_id) AS filename, coalesce(page, '?') AS page FROM seen s LEFT JOIN files f ON f.chunk_id = s.chunk_id),
own AS (SELECT entity_id, name, filename, min(nth) AS nth, arg_min(page, nth) AS page FROM known GROUP BY ALL),
sizes AS (SELECT entity_id, count(*) AS n FROM own GROUP BY entity_id),
attributes AS (
  SELECT e.name, coalesce(type, 'unknown') AS entity_type, coalesce(description, '') AS description, coalesce(f.filename, first_seen_document) AS first_path, coalesce(f.page, '?') AS first_page,
    row_number() OVER (PARTITION BY e.name ORDER BY coalesce(n, 0) DESC, e.entity_id) AS r FROM entities e LEFT JOIN sizes USING (entity_id) LEFT JOIN files f ON f.chunk_id = first_seen_document),
every AS (SELECT name, filename, arg_min(page, entity_id * 1000000 + nth) AS page, min(entity_id * 1000000 + nth) AS o FROM own GROUP BY name, filename),
listed AS (SELECT name, count(*) AS document_count, string_agg(filename || ':' || page, '|' ORDER BY o) AS documents FROM every GROUP BY name),
nodes AS (SELECT a.name, entity_type, description, document_count, regexp_extract(first_path, '[^/]*$') AS first_seen_display, first_page AS first_seen_page, documents FROM attributes a JOIN listed USING (name) WHERE r = 1)"""
_EDGES = f"""{_RELS}, names AS (SELECT p_name AS name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem) UNION SELECT s_name FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)),
numbered AS (
  SELECT least(source, target) AS source, greatest(source, target) AS target, concat_ws(',', type, description, document_id) AS r, row_number() OVER (PARTITION BY least(source, target), greatest(source, target) ORDER BY relationship_id, type, description, document_id) AS n
  FROM rels WHERE source IN (SELECT name FROM names) AND target IN (SELECT name FROM names)),
edges AS (SELECT source, target, count(*) AS weight, string_agg(r, '|' ORDER BY n) FILTER (n <= 5) AS relationships FROM numbered GROUP BY source, target),
degrees AS (SELECT name, CAST(sum(weight) AS BIGINT) AS connections FROM (SELECT source AS name, weight FROM edges UNION ALL SELECT target, weight FROM edges) GROUP BY name)"""
_STATS = f"{_CHUNKS}, stats AS (SELECT ltrim(regexp_replace(filename, '_[0-9]+$', ''), '/') AS path, count(*) AS chunks, CAST(sum(token_count) AS BIGINT) AS tokens FROM chunks GROUP BY 1)"


def _children(depth: int, where: str = "true") -> str:
    return f"""SELECT string_split(path, '/')[{depth + 1}] AS name, max(len(string_split(path, '/')) > {depth + 1}) AS is_folder, count(*) AS files, CAST(sum(chunks) AS BIGINT) AS chunks, CAST(sum(tokens) AS BIGINT) AS tokens
FROM stats WHERE len(string_split(path, '/')) > {depth} AND {where} GROUP BY 1"""


_BREAK = "\\r\\n|[\\n\\x0b\\x0c\\r\\x{85}\\x{2028}\\x{2029}]"


def _split(text: str) -> str:
    """Lines of a text; one line break at its end makes no line."""
    return f"(CASE WHEN {text} = '' THEN [] ELSE regexp_split_to_array(regexp_replace({text}, '({_BREAK})$', ''), '{_BREAK}') END)"


#: A fold over the chunks of each document, as a recursion over their number.
_FOLD = f"""WITH RECURSIVE {_CHUNKS},
listed AS (SELECT source_path AS base_path, list(text ORDER BY chunk_index) AS c FROM chunks GROUP BY source_path),
fold(base_path, c, i, acc) AS (
  SELECT base_path, c, 1, {_split('c[1]')} FROM listed
  UNION ALL SELECT base_path, c, i + 1, acc || l[coalesce(list_max(list_filter(range(1, least(len(acc), len(l), 100) + 1), lambda n: acc[len(acc) - n + 1:] = l[1:n])), 0) + 1:]
  FROM (SELECT *, {_split('c[i + 1]')} AS l FROM fold WHERE i < len(c))),
whole AS (SELECT base_path, CASE WHEN len(c) = 1 THEN c[1] ELSE array_to_string(acc, chr(10)) END AS text FROM fold WHERE i = len(c))"""


ORACLE_SQL: dict[str, str] = {
    "reassemble_doc": f"{_FOLD} SELECT base_path, length(text) AS n_chars, sha256(text) AS text_sha256 FROM whole",
    "line_chunks": f"WITH {_CHUNKS} SELECT chunk_id, filename, chunk_index, sha256(text) AS text_sha256, token_count FROM chunks",
    "chunk_stats": f"WITH {_CHUNKS} SELECT count(*) AS total_chunks, count(DISTINCT filename) AS unique_files, coalesce(round(avg(token_count), 2), 0) AS avg_tokens, CAST(coalesce(sum(token_count), 0) AS BIGINT) AS total_tokens FROM chunks",
    "count_documents": f"WITH {_CHUNKS} SELECT count(DISTINCT source_path) AS documents FROM chunks",
    "split_chunk_key": f"WITH {_CHUNKS} SELECT chunk_id, regexp_extract(filename, '^(.*)_([0-9]+)$', 1) AS base, CAST(regexp_extract(filename, '^(.*)_([0-9]+)$', 2) AS INT) AS idx FROM chunks",
    "page_ref": f"WITH {_CHUNKS} SELECT chunk_id, source_path AS filename, CAST(chunk_index + 1 AS VARCHAR) AS page FROM chunks",
    "resume_files": f"WITH {_CHUNKS} SELECT base_path AS path, doc_id FROM docs WHERE base_path NOT IN (SELECT source_path FROM chunks WHERE chunk_id % 20000000 < 10000000)",
    "delete_like_counts": f"WITH {_CHUNKS} SELECT count(*) AS n_before, count(*) FILTER (filename ILIKE '%SRC1/en/doc_%') AS n_deleted, count(*) FILTER (NOT filename ILIKE '%SRC1/en/doc_%') AS n_after FROM chunks",
    "chapter_files": """SELECT CAST(o_orderkey AS VARCHAR) AS chunk_id, 'Chapter ' || CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderkey % 50 AS VARCHAR) ELSE '?' END AS filename,
CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 7 + 1 AS VARCHAR) ELSE '?' END AS page FROM orders""",
    "delete_by_name": f"WITH {_CHUNKS} SELECT chunk_id, filename FROM chunks WHERE NOT filename ILIKE '%SRC1/en/doc_%'",
    "upsert_documents": f"WITH {_LETTERS} SELECT document_id, sender, CASE WHEN CAST(document_id AS BIGINT) % 3 = 0 THEN 'changed' ELSE subject END AS subject, CAST(CASE WHEN CAST(document_id AS BIGINT) % 3 = 0 THEN 2 ELSE 1 END AS INT) AS version FROM letters",
    "decode_latin1": "SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[^\\x00-\\xFF]', '?', 'g')) AS text_sha256 FROM documents",
    "old_schema": f"WITH {_LETTERS} SELECT document_id, CASE WHEN reference = 'P' OR reference IS NULL THEN 'none' ELSE reference END AS reference, '' AS cc FROM letters",
    "exact_hash_groups": f"WITH {_DOCS}, {_hashed('exact', 'docs', 'text')} SELECT * FROM exact",
    "norm_hash_groups": f"WITH {_VARIANTS}, {_groups('x')} SELECT * FROM normalized",
    "hash_stage_stats": f"WITH {_VARIANTS}, {_groups('x')} SELECT hash_type, count(DISTINCT content_hash) AS n_groups, count(*) AS n_docs FROM grp GROUP BY hash_type",
    "group_ids": f"WITH {_VARIANTS}, {_groups('x')} SELECT dense_rank() OVER (ORDER BY hash_type, first_path) - 1 AS group_id, base_path, hash_type FROM grp",
    "lsh_representatives": f"WITH {_VARIANTS}, {_groups('x')} SELECT base_path FROM x WHERE base_path NOT IN (SELECT base_path FROM grp WHERE base_path <> first_path)",
    "minhash_sig": f"WITH {_DOCS}, {_signatures('docs')} SELECT base_path, CAST(slot AS INT) AS slot, value FROM sig",
    "band_join": f"WITH {_PAIRS} SELECT * FROM pairs",
    "min_jaccard": f"WITH {_PAIRS} SELECT * FROM pairs WHERE jaccard_est >= 0.8",
    "candidate_docs": f"WITH {_PAIRS} SELECT path_a AS base_path FROM pairs UNION SELECT path_b FROM pairs",
    "pair_degree": f"WITH {_DEGREES} SELECT * FROM deg",
    "pair_histogram": f"""WITH {_DEGREES} SELECT CASE WHEN pair_count = 1 THEN '1' WHEN pair_count <= 5 THEN '2-5' WHEN pair_count <= 20 THEN '6-20' WHEN pair_count <= 100 THEN '21-100' WHEN pair_count <= 500 THEN '101-500' ELSE '500+' END AS bucket,
count(*) AS n_docs, min(pair_count) AS min_pairs, max(pair_count) AS max_pairs FROM deg GROUP BY 1""",
    "top_by_pairs": f"WITH {_DEGREES} SELECT * FROM deg ORDER BY pair_count DESC, base_path LIMIT 20",
    "score_pairs": """WITH p AS (SELECT vec_id AS a, CASE WHEN vec_id % 5 <> 4 THEN vec_id + 1 END AS b FROM embeddings)
SELECT CAST(a AS VARCHAR) AS path_a, coalesce(CAST(b AS VARCHAR), 'none') AS path_b, round(list_dot_product(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])), 6) AS cosine_sim, y.vec_id IS NULL AS skipped
FROM p JOIN embeddings x ON x.vec_id = a LEFT JOIN embeddings y ON y.vec_id = b""",
    "truncate_words": """WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))
SELECT doc_id, sha256(CASE WHEN len(w) > 100 THEN array_to_string(w[1:100], ' ') ELSE text END) AS text_sha256 FROM w""",
    "embed_duplicates": f"""WITH {_PAIRS}, w AS (SELECT base_path, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w, text FROM docs),
cut AS (SELECT base_path, lower(CASE WHEN len(w) > 512 THEN array_to_string(w[1:512], ' ') ELSE text END) AS t FROM w),
vec AS (SELECT base_path, list_transform(string_split('abcdefghijklmnopqrstuvwxyz', ''), lambda c: CAST(length(t) - length(replace(t, c, '')) AS DOUBLE)) AS v FROM cut),
sims AS (SELECT path_a, path_b, list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) AS sim FROM pairs JOIN vec a ON a.base_path = path_a JOIN vec b ON b.base_path = path_b
  WHERE list_dot_product(a.v, a.v) > 0 AND list_dot_product(b.v, b.v) > 0)
SELECT path_a, path_b, round(sim, 4) AS cosine_sim FROM sims WHERE sim >= 0.92""",
    "dedup_manifest": f"WITH RECURSIVE {_MANIFEST} SELECT * FROM manifest",
    "hash_components": f"WITH {_DOCS}, {_hashed('exact', 'docs', 'text')} SELECT base_path AS node, first_path AS component FROM exact",
    "cluster_ids": f"WITH RECURSIVE {_MANIFEST} SELECT base_path, dense_rank() OVER (ORDER BY cluster) - 1 AS cluster_id FROM manifest",
    "cluster_histogram": f"""WITH RECURSIVE {_MANIFEST}, sizes AS (SELECT cluster, count(*) AS n FROM manifest GROUP BY cluster)
SELECT CASE WHEN n = 1 THEN '1' WHEN n <= 5 THEN '2-5' WHEN n <= 20 THEN '6-20' WHEN n <= 100 THEN '21-100' ELSE '100+' END AS bucket, count(*) AS n_clusters FROM sizes GROUP BY 1""",
    "largest_clusters": f"WITH RECURSIVE {_MANIFEST} SELECT max(base_path) FILTER (is_representative) AS representative, count(*) AS size FROM manifest GROUP BY cluster ORDER BY size DESC, representative DESC LIMIT 10",
    "dedup_summary": f"""WITH RECURSIVE {_MANIFEST} SELECT count(*) AS total_docs, count(DISTINCT cluster) AS n_clusters, count(*) FILTER (is_representative) AS keep, count(*) FILTER (NOT is_representative) AS "drop",
round(100.0 * count(*) FILTER (NOT is_representative) / count(*), 1) AS reduction_pct FROM manifest""",
    "status_flagged": f"WITH {_PAIRS} SELECT count(DISTINCT p) AS flagged FROM (SELECT base_path AS p FROM grp UNION ALL SELECT path_a FROM pairs WHERE jaccard_est >= 0.9 UNION ALL SELECT path_b FROM pairs WHERE jaccard_est >= 0.9)",
    "parse_replies": f"WITH {_JSON} SELECT chunk_id, bare, CAST(CASE WHEN readable THEN 3 ELSE 0 END AS INT) AS n_entities FROM parsed",
    "extract_documents": f"""WITH {_JSON} SELECT CAST(chunk_id AS VARCHAR) AS document_id, CASE WHEN readable THEN source ELSE '' END AS sender, CASE WHEN readable THEN lang || ', ' || source ELSE '' END AS recipient,
'' AS cc, '' AS bcc, CASE WHEN readable THEN '2024-01-01' ELSE '' END AS date, '' AS subject, '' AS reference FROM parsed""",
    "entity_fold": f"WITH {_JSON} SELECT * FROM folded",
    "extract_relationships": f"WITH {_JSON} SELECT * FROM rel",
    "processing_log": f"WITH {_JSON} SELECT CAST(chunk_id AS VARCHAR) AS document_id, true AS success, readable FROM parsed",
    "extraction_failures": f"""WITH {_JSON}, d AS (SELECT chunk_id, chunk_id % 11 = 0 AS failed FROM said)
SELECT CAST(chunk_id AS VARCHAR) AS document_id, NOT failed AS success, CASE WHEN failed THEN 'ValueError: no reply' END AS error_message, NOT failed AND parsed.readable AS readable,
  CAST(coalesce(m.n, 0) AS BIGINT) AS n_mentions FROM d JOIN parsed USING (chunk_id) LEFT JOIN (SELECT chunk_id, count(*) AS n FROM mentions WHERE chunk_id % 11 <> 0 GROUP BY chunk_id) m USING (chunk_id)""",
    "resume_docs": "SELECT doc_id AS chunk_id FROM documents WHERE doc_id % 4 IN (0, 1)",
    "extract_stats": f"""WITH {_JSON} SELECT count(*) AS documents, count(DISTINCT CASE WHEN readable THEN source END) AS senders, count(DISTINCT CASE WHEN readable THEN lang || ', ' || source END) AS recipients,
(SELECT count(*) FROM folded) AS entities, (SELECT count(*) FROM rel) AS relationships FROM parsed""",
    "normalize_name": f"""WITH n AS (SELECT DISTINCT 'Dr. ' || array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') || ' (' || p_type || '), Inc.' AS name FROM part UNION SELECT s_name || ' - Co.' FROM supplier)
SELECT name, {_key('name')} AS key FROM n""",
    "merge_groups": f"WITH {_MERGE} SELECT entity_id, group_key, group_size, CAST(n_docs AS INT) AS n_docs, CAST(rank AS INT) AS rank, canonical FROM members",
    "merged_entities": f"WITH {_MERGED} SELECT entity_id, name, type, description, first_seen_document, sha256(array_to_string(documents_appeared, '|')) AS documents_appeared FROM merged",
    "entity_text": f"""WITH {_ENTITIES} SELECT entity_id, trim(name || ' (' || type || '): ' || coalesce(description, '')) AS entity_text,
array_to_string(list_sort(list_distinct(list_filter(string_split({_key('name')}, ' '), lambda t: length(t) >= 2 AND NOT list_contains({_STOP}, t)))), ' ') AS tokens FROM entities""",
    "map_names": f"""WITH {_LETTERS} SELECT document_id, CASE WHEN old IS NOT NULL THEN canonical ELSE sender END AS sender, CASE WHEN recipient = 'small ring Inc.' THEN 'small ring' ELSE recipient END AS recipient,
CAST((old IS NOT NULL)::INT + (recipient = 'small ring Inc.')::INT AS INT) AS n_changed
FROM letters LEFT JOIN (SELECT DISTINCT c_name AS old, 'Customer ' || c_custkey AS canonical FROM customer WHERE c_custkey % 2 = 0) ON old = sender""",
    "token_block_join": f"WITH RECURSIVE {_ENTITIES}, {_blocked('entities')} SELECT * FROM blocked",
    "scored_pairs": f"WITH RECURSIVE {_ENTITIES}, {_blocked('entities')} SELECT * FROM scored",
    "cluster_pairs": f"""WITH RECURSIVE {_MERGED}, {_blocked('merged')}, {_reach('SELECT name_a AS src, name_b AS dst FROM scored WHERE combined >= 0.8')}
SELECT name, component AS group_key, first_value(name) OVER (PARTITION BY component ORDER BY len(documents_appeared) DESC, length(name) DESC, entity_id) AS canonical FROM merged JOIN found ON node = name""",
    "report_pairs": f"WITH RECURSIVE {_ENTITIES}, {_blocked('entities')} SELECT * FROM scored WHERE combined >= 0.5 ORDER BY combined DESC, name_a, name_b LIMIT 500",
    "merge_samples": f"""WITH {_MERGE}, top AS (SELECT group_key, canonical, count(*) AS member_count FROM members GROUP BY ALL ORDER BY 3 DESC, 2, 1 LIMIT 10),
others AS (SELECT group_key, list(name ORDER BY rank) AS o FROM members WHERE name <> canonical GROUP BY group_key)
SELECT canonical, member_count, coalesce(array_to_string(o[1:5], '|'), '') AS others FROM top LEFT JOIN others USING (group_key)""",
    "report_groups": f"WITH {_MERGE} SELECT canonical, count(*) AS member_count, string_agg(name, '|' ORDER BY rank) AS members FROM members GROUP BY group_key, canonical",
    "rel_dedup": f"WITH {_RELS} SELECT min(relationship_id) AS relationship_id, source, target, type, document_id FROM rels GROUP BY source, target, type, document_id",
    "rewrite_stats": f"""WITH {_MERGED}, {_RELS}, d AS (SELECT count(*) AS n FROM (SELECT DISTINCT source, target, type, document_id FROM rels))
SELECT (SELECT count(*) FROM entities) AS original_entities, (SELECT count(*) FROM merged) AS final_entities, (SELECT count(*) FROM rels) AS original_relationships, (SELECT n FROM d) AS final_relationships,
(SELECT count(*) FROM rels WHERE relationship_id % 5 = 0) AS relationships_rewritten, (SELECT count(DISTINCT group_key) FROM members) AS merge_groups, (SELECT count(*) FROM members) AS entities_involved,
(SELECT count(*) FROM entities) - (SELECT count(*) FROM merged) AS entities_removed, (SELECT count(*) FROM rels) - (SELECT n FROM d) AS relationships_deduped""",
    "report_stats": f"""WITH RECURSIVE {_MERGED}, {_RELS}, {_blocked('entities')}, d AS (SELECT count(*) AS n FROM (SELECT DISTINCT source, target, type, document_id FROM rels)),
n AS (SELECT (SELECT count(*) FROM entities) AS e, (SELECT count(*) FROM merged) AS f, (SELECT count(*) FROM rels) AS r, (SELECT n FROM d) AS s, (SELECT count(DISTINCT group_key) FROM members) AS g, (SELECT count(*) FROM members) AS i, (SELECT count(*) FROM scored WHERE combined >= 0.9) AS p)
SELECT false AS dry_run, 'entities' AS source_db, 'merged' AS output_db, 0.9::DOUBLE AS threshold, e AS original_entities, f AS final_entities, e - f AS entities_removed, r AS original_relationships, s AS final_relationships, 0 AS relationships_rewritten, r - s AS relationships_deduped, p AS candidate_pairs, g AS merge_groups, i AS entities_involved FROM n
UNION ALL SELECT true, 'entities', 'merged', 0.9, e, e - i + g, i - g, r, r, 0, 0, p, g, i FROM n""",
    "topk_neighbours": f"WITH {_TOPK} SELECT i, j, round(sim, 6) AS sim, CAST(rank AS INT) AS rank FROM ranked WHERE rank <= 10",
    "similarity_topk_join": f"WITH {_TOPK} SELECT i, j, round(sim, 4) AS sim FROM ranked WHERE rank <= 10 AND j > i AND sim >= 0.4",
    "cosine_self": "SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 5) AS norm2 FROM embeddings",
    "node_merge": f"WITH {_NODES} SELECT name, entity_type, description, CAST(document_count AS INT) AS document_count, first_seen_display, first_seen_page, documents FROM nodes",
    "edge_agg": f"WITH {_EDGES} SELECT * FROM edges",
    "degree": f"WITH {_EDGES} SELECT * FROM degrees",
    "search_text": f"""WITH {_NODES}, {_RELS}, {_LETTERS},
d AS (SELECT name, string_agg(t, ' ' ORDER BY t) AS d FROM (SELECT DISTINCT s.name, concat_ws(' ', subject, sender, recipient, reference) AS t FROM seen s JOIN letters ON document_id = chunk_id) GROUP BY name),
r AS (SELECT name, string_agg(t, ' ' ORDER BY t) AS r FROM (SELECT source AS name, type || ' ' || description AS t FROM rels UNION SELECT target, type || ' ' || description FROM rels) GROUP BY name)
SELECT n.name, sha256(lower(concat_ws(' ', n.name, entity_type, nullif(description, ''), d, r))) AS search_sha256 FROM nodes n LEFT JOIN d USING (name) LEFT JOIN r USING (name)""",
    "type_counts": f"WITH {_NODES} SELECT entity_type, count(*) AS n FROM nodes GROUP BY entity_type",
    "top_connected": f"WITH {_NODES}, {_EDGES} SELECT n.name, entity_type, coalesce(connections, 0) AS connections FROM nodes n LEFT JOIN degrees USING (name) ORDER BY 3 DESC, 1 LIMIT 10",
    "graph_stats": f"WITH {_NODES}, {_EDGES} SELECT (SELECT count(*) FROM nodes) AS node_count, count(*) AS edge_count, CAST(sum(weight) AS BIGINT) AS relationship_count FROM edges",
    "file_stats": f"WITH {_STATS} SELECT * FROM stats",
    "children_rollup": f"WITH {_STATS} {_children(1, "string_split(path, '/')[1] = 'data'")}",
    "auto_skip": f"WITH {_STATS} SELECT *, 'data' AS prefix FROM ({_children(1)})",
}
