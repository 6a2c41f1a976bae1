"""DuckDB SQL of the queries that SQL can express on whole tables."""

_GAPS = r"[\x20\x09-\x0D]"

ORACLE = {
    "op1_exact_dedup": rf"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '{_GAPS}', '', 'g') AS norm FROM documents
), g AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size FROM n
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM g
""",
    "op4_url_filter": """
WITH r(rule, verdict) AS (
  VALUES ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'), ('com/fr/', 'allow'), ('com/de/', 'block')
), a AS (
  SELECT row_number() OVER () AS n, page_id,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT n, page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, rest FROM a
), u AS (
  SELECT n, page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM h
), f AS (
  SELECT n, rule, verdict, row_number() OVER (PARTITION BY n ORDER BY length(rule) DESC, instr(rule, '/') DESC) AS k
  FROM u JOIN r ON (host = split_part(rule, '/', 1) OR suffix(host, '.' || split_part(rule, '/', 1)))
               AND starts_with(path, substr(rule, instr(rule, '/')))
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN (SELECT * FROM f WHERE k = 1) USING (n)
""",
    "op5_source_mix": r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, '')))), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS draw
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size) AS DOUBLE) * 2 AS cap FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS w FROM s
), o AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, source) AS k, sum(source_size) OVER () * 1.5::DOUBLE AS share,
         coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
         sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w
), l AS (
  SELECT arg_min((share - spent) / rest, k) AS level FROM o WHERE w * ((share - spent) / rest) <= cap
), t AS (
  SELECT source, source_size, least(w * level, cap) AS target, CASE WHEN source_size > 0 THEN least(w * level, cap) / source_size ELSE 0 END AS rate FROM w, l
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
""",
    "op6_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda e: e <> 0)) > 0
), p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, p.b FROM reach JOIN p ON reach.b = p.a
), c AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), n AS (
  SELECT a AS vec_id, count(*) AS n_links FROM p GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
""",
    "op7_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), p AS (
  SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, ws FROM w
), s AS (
  SELECT doc_id, i, ws[i] AS word, CASE WHEN i + 19 <= len(ws) THEN array_to_string(ws[i:i + 19], ' ') END AS seq FROM p
), r AS (
  SELECT doc_id, i, word, seq IS NOT NULL AND row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) > 1 AS again FROM s
), c AS (
  SELECT doc_id, i, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM r
), k AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS n_gone, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept
  FROM c GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(n_gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN k USING (doc_id)
""",
    "op11_line_dedup": r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM d
), k AS (
  SELECT doc_id, line, i, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT doc_id, line, i, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) < doc_id AS gone FROM k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
""",
    "op12_spelling_variants": r"""
WITH RECURSIVE bits AS (
  SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t FROM range(256) r(b)
), tab AS (
  SELECT list(t ORDER BY b) AS t FROM bits
), r AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), u AS (
  SELECT run, hex(encode(doc_id || ':' || run)) AS x, count(*) AS k FROM r WHERE length(run) >= 7 GROUP BY ALL
), h AS (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
                                 lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h FROM u, tab
), w AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, k FROM h
), v AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), d AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)
), p AS (
  SELECT a.word, b.word AS other FROM d a JOIN d b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT d.word, v.word FROM d JOIN v ON d.less = v.word
  UNION SELECT v.word, d.word FROM d JOIN v ON d.less = v.word
), f AS (
  SELECT p.word, count(*) AS n_near, max(o.n) AS most, arg_min(o.word, (-o.n, o.word)) AS best FROM p JOIN v o ON p.other = o.word GROUP BY p.word
), g AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN best END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n
  FROM v LEFT JOIN f USING (word)
), c(word, root) AS (
  SELECT word, word FROM g UNION ALL SELECT c.word, g.form FROM c JOIN g ON c.root = g.word WHERE g.form IS NOT NULL
), e AS (
  SELECT c.word, c.root FROM c JOIN g ON c.root = g.word WHERE g.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM g JOIN e USING (word)
""",
    "op13_conversation_trie": r"""
WITH bits AS (
  SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t FROM range(256) r(b)
), tab AS (
  SELECT list(t ORDER BY b) AS t FROM bits
), c AS (
  SELECT conv_id, hex(encode(CAST(conv_id AS VARCHAR))) AS x,
         list(strlen(coalesce(text, '')) || ' ' || sha256(coalesce(role, '') || chr(0) || coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
                                         lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 9 AS h FROM c, tab
), s AS (
  SELECT h.conv_id, list_concat(coalesce(b.turns, [])[1:h], h.turns[h + 1:]) AS seq FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 5
), p AS (
  SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS depth FROM s
), n AS (
  SELECT seq[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = len(seq)), '')) AS ends_sha256
  FROM p GROUP BY ALL
), k AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL
), e AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * CAST(split_part(path[depth], ' ', 1) AS BIGINT) END AS saved FROM n LEFT JOIN k USING (path)
), a AS (
  SELECT path, n_children = 0 AS leaf, saved, unnest(range(0, depth + 1)) AS up FROM e
), t AS (
  SELECT path[1:up] AS path, count(*) FILTER (leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM a GROUP BY ALL
)
SELECT e.conv_id, e.depth, u.conv_id AS parent_conv_id, e.n_convs, e.n_children, n_leaves, saved_tokens, e.ends_sha256
FROM e JOIN t USING (path) LEFT JOIN e u ON e.depth > 0 AND u.path = e.path[1:e.depth - 1]
""",
}
