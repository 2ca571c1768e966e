"""DuckDB SQL for the operators that SQL can express; it follows the contract, not the Spark plan."""

from keyloom.llm.quality import STOP_WORDS

BLANK = r"[ \t\n\v\f\r]"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^ \t\n\v\f\r]+')"
_stops = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws.split()}))

OP1 = r"""WITH RECURSIVE p AS (SELECT page_id, url, html,
  CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
  CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
  CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) END AS rest FROM pages),
n AS (SELECT *, CASE WHEN rest IS NOT NULL THEN host || rest END AS node FROM p),
g AS (SELECT *, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>')) AS tag, 'href' AS name FROM n WHERE node IS NOT NULL
 UNION ALL SELECT *, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>')), 'url' FROM n WHERE node IS NOT NULL),
t AS (SELECT *, regexp_extract(tag, CASE name WHEN 'href' THEN '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)' ELSE '(?is)\burl\s*=\s*["'']?([^"''\s>]+)' END, 1) AS link FROM g),
a AS (SELECT node, replace(link, '&amp;', '&') AS link, regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) AS origin, regexp_extract(url, '(?s)^(.*?:)//', 1) AS scheme, regexp_replace(path, '[^/]*$', '') AS folder FROM t WHERE link <> ''),
b AS (SELECT node, CASE WHEN strpos(link, '://') > 0 THEN link WHEN starts_with(link, '//') THEN scheme || link WHEN starts_with(link, '/') THEN origin || link
  ELSE origin || CASE folder WHEN '' THEN '/' ELSE folder END || link END AS link FROM a),
e AS (SELECT node AS x, translate(regexp_extract(link, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(link, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS y FROM b),
e2 AS (SELECT x, y FROM e WHERE x <> y UNION SELECT y, x FROM e WHERE x <> y),
r AS (SELECT x AS node, x AS reach FROM e2 UNION SELECT r.node, e2.y FROM r JOIN e2 ON r.reach = e2.x),
c AS (SELECT node, min(reach) AS component FROM r GROUP BY node),
rules(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
places AS (SELECT DISTINCT host, path FROM n UNION SELECT DISTINCT regexp_extract(node, '^[^/?]*', 0), regexp_extract(node, '(?s)^[^/?]*([^?]*)', 1) FROM c),
fit AS (SELECT host, path, min((-length(rhost || rpath), rhost || rpath, verdict)) AS best FROM places JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY host, path),
d AS (SELECT component, max(CASE WHEN best[3] = 'allow' THEN 2 ELSE 1 END) AS strongest FROM c JOIN fit ON fit.host = regexp_extract(node, '^[^/?]*', 0) AND fit.path = regexp_extract(node, '(?s)^[^/?]*([^?]*)', 1) GROUP BY component)
SELECT page_id, n.host, n.path, best[2] AS rule, coalesce(best[3], CASE WHEN strongest = 1 THEN 'block' ELSE 'allow' END) AS verdict, c.component
FROM n LEFT JOIN fit ON n.host = fit.host AND n.path = fit.path LEFT JOIN c ON n.node = c.node LEFT JOIN d ON c.component = d.component"""

OP4 = rf"""WITH t AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT id, unnest({WORDS}) AS w, generate_subscripts({WORDS}, 1) AS i FROM t),
g AS (SELECT id, i, w || chr(1) || lead(w, 1) OVER o || chr(1) || lead(w, 2) OVER o || chr(1) || lead(w, 3) OVER o || chr(1) || lead(w, 4) OVER o AS five FROM w WINDOW o AS (PARTITION BY id ORDER BY i)),
twice AS (SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, five) AS k FROM g WHERE five IS NOT NULL) WHERE k > 1),
rep AS (SELECT id, count(DISTINCT i + o.o) AS n_repeat_words FROM twice, (VALUES (0), (1), (2), (3), (4)) o(o) GROUP BY id),
cw AS (SELECT id, count(*) AS n_words, sum(length(w)) AS word_chars, count(*) FILTER (lower(w) IN ({_stops})) AS n_stop, count(*) FILTER (regexp_matches(w, '\pL')) AS n_alpha FROM w GROUP BY id),
l AS (SELECT id, unnest(string_split(text, chr(10))) AS x FROM t),
cl AS (SELECT id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup, count(*) FILTER (regexp_matches(x, '^[ \t\v\f\r]*[-*•]')) AS n_bullet, count(*) FILTER (regexp_matches(x, '(\.\.\.|…)[ \t\v\f\r]*$')) AS n_ellipsis FROM l WHERE regexp_matches(x, '[^ \t\n\v\f\r]') GROUP BY id),
m AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
 coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_stop, 0) AS n_stop, coalesce(n_alpha, 0) AS n_alpha, coalesce(n_lines, 0) AS n_lines, coalesce(n_bullet, 0) AS n_bullet, coalesce(n_ellipsis, 0) AS n_ellipsis
 FROM t LEFT JOIN cw USING (id) LEFT JOIN cl USING (id) LEFT JOIN rep USING (id)),
x AS (SELECT *, concat_ws(',', CASE WHEN n_words < 10 OR n_words > 100000 THEN 'length' END,
 CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words OR n_words = 0 THEN 'mean_word' END, CASE WHEN n_symbols > 0.3 * word_chars AND word_chars > 0 THEN 'symbols' END,
 CASE WHEN n_words = 0 OR n_stop / n_words::DOUBLE < 0.01 THEN 'stop_words' END, CASE WHEN n_lines > 0 AND n_dup_lines / n_lines::DOUBLE > 0.3 THEN 'dup_lines' END,
 CASE WHEN n_words > 0 AND n_repeat_words / n_words::DOUBLE > 0.2 THEN 'repeats' END, CASE WHEN n_lines > 0 AND n_bullet / n_lines::DOUBLE > 0.9 THEN 'bullets' END,
 CASE WHEN n_lines > 0 AND n_ellipsis / n_lines::DOUBLE > 0.3 THEN 'ellipses' END, CASE WHEN n_words = 0 OR n_alpha / n_words::DOUBLE < 0.6 THEN 'alphabetic' END) AS failed_rules FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
 (NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND failed_rules = '') AS kept, failed_rules FROM x"""

OP7 = rf"""WITH RECURSIVE t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT doc_id, unnest({WORDS}) AS w, generate_subscripts({WORDS}, 1) AS i, len({WORDS}) AS n FROM t),
g AS (SELECT doc_id, n, i, w || coalesce(chr(1) || lead(w, 1) OVER o, '') || coalesce(chr(1) || lead(w, 2) OVER o, '') || coalesce(chr(1) || lead(w, 3) OVER o, '') AS s FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT DISTINCT doc_id, s FROM g WHERE i <= greatest(1, n - 3)), k AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM both_ JOIN k p ON p.doc_id = x JOIN k q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
r AS (SELECT x AS node, x AS reach FROM e UNION SELECT r.node, e.y FROM r JOIN e ON r.reach = e.x),
c AS (SELECT node, min(reach) AS component FROM r GROUP BY node), l AS (SELECT x, count(*) AS n_links FROM e GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(component, d.doc_id)) AS component_id, coalesce(n_links, 0) AS n_links
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN c ON c.node = d.doc_id LEFT JOIN l ON l.x = d.doc_id"""

OP8 = """WITH f AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score FROM f q JOIN f c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""

_five = " + ".join(f"{16 >> i} * CAST(substr(bits, CAST(5 * j + {i + 1} AS INTEGER), 1) AS INTEGER)" for i in range(5))
OP12 = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex, coalesce(first <> page_id, first IS NOT NULL) AS again, first FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(strpos('0123456789abcdef', substr(hex, CAST(i AS INTEGER), 1)) - 1), 4, '0')), '') AS bits FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_five}, 1)), '') AS payload_digest,
 CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to FROM b"""

OP13 = """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
 WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
f AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM e),
s AS (SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same, CAST(sum(a.x * o.x) AS BIGINT) AS score FROM f a JOIN f o ON a.i = o.i AND a.vec_id <> o.vec_id WHERE a.vec_id % 50 = 0 GROUP BY 1, 2, 3),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
w AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
 FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM w WHERE rank <= 3"""

ORACLE_SQL = {"op1_url_filter": OP1, "op4_quality_rules": OP4, "op7_ngram_jaccard_join": OP7, "op8_exact_top_k": OP8, "op12_warc": OP12, "op13_hard_negatives": OP13}
