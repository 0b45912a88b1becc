"""DuckDB SQL of the training-data queries that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# the generated pages have one template: blocks of an article are closed or opened by p and h1 tags
OP1_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS body FROM pages),
b AS (SELECT page_id, regexp_split_to_array(body, '</?(?:p|h1)>') AS blocks FROM a),
s AS (SELECT page_id, unnest(blocks) AS block, unnest(range(1, len(blocks) + 1)) AS i FROM b),
t AS (SELECT page_id, i, regexp_replace(regexp_replace(block, '<br>', ' ', 'g'), '</?[a-z][^>]*>', '', 'g') AS raw FROM s),
r AS (SELECT page_id, i, replace(replace(regexp_replace(raw, '&quot;?', '"', 'g'), '&lt;', '<'), '&gt;', '>') AS raw FROM t),
u AS (SELECT page_id, i, trim(regexp_replace(regexp_replace(raw, '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS line FROM r),
j AS (SELECT page_id, string_agg(line, chr(10) || chr(10) ORDER BY i) AS text FROM u WHERE line <> '' GROUP BY page_id)
SELECT a.page_id, a.url, coalesce(j.text, '') AS text, length(coalesce(j.text, ''))::BIGINT AS n_chars FROM a LEFT JOIN j USING (page_id)
"""

OP5_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, 4 + length(role) + 2 + length(text) + 8
  + length(regexp_replace(text, '[^\\]', '', 'g')) + (length(text) - length(replace(text, '</turn>', ''))) // 7
  + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0) AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

OP9_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_AZ}', '{_az}'), '{WORD}') AS w FROM documents),
x AS (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, w[i] || ' ' || coalesce(w[i + 1], '') AS g FROM x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS id, a AS top FROM e UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.top),
m AS (SELECT id, min(top) AS top FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.top, d.doc_id) AS component_id, coalesce(m.top, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.id = d.doc_id
"""

OP11_SQL = rf"""
WITH b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_AZ}', '{_az}'), '{TOKEN}') AS w FROM benchmark),
i AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0),
v AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM i),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_AZ}', '{_az}'), '{TOKEN}') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
g AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM p, (SELECT DISTINCT n FROM v) WHERE i + n - 1 <= len(w)),
o AS (SELECT doc_id, i, n, item_id FROM g JOIN v USING (n, g)),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM o) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM o) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN s USING (doc_id)
"""
