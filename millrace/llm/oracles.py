"""SQL for the training-data queries that SQL can express, for DuckDB on the same tables.

Mixing (rounding by hash), tokens, disguised personal data, learnt scores, media files and id files have
none: tests hold those against brute force.
"""

from __future__ import annotations

EMBEDDINGS = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
good AS (SELECT * FROM v WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
r AS (SELECT vec_id AS id, vec_id AS seen FROM v UNION SELECT r.id, e.y FROM r JOIN e ON r.seen = e.x),
c AS (SELECT id, min(seen) AS root FROM r GROUP BY id), n AS (SELECT x, count(*) AS n FROM e GROUP BY x)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, root AS component_id, id = root AS kept FROM c LEFT JOIN n ON x = id
"""

CHATS = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
c AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
  sum(length(regexp_replace(role, '(<turn>|</turn>|\\|:\n)', '\\\1', 'g')) + length(regexp_replace(text, '(<turn>|</turn>|\\)', '\\\1', 'g')) + 16)::BIGINT AS formatted_chars FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM c
"""

NGRAMS = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM w),
u AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
e AS (SELECT a.doc_id AS x, b.doc_id AS y FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS id, doc_id AS seen FROM s UNION SELECT r.id, e.y FROM r JOIN e ON r.seen = e.x)
SELECT doc_id, len(g) AS n_shingles, root AS component_id FROM s JOIN (SELECT id, min(seen) AS root FROM r GROUP BY id) ON id = doc_id
"""

_SHRINK = """SELECT *, rate * (1 - rate) / (strength + n + 1) + power(strength / (strength + n), 2) * prior_var AS var FROM (SELECT m.*, strength, (prior * strength + bad) / (strength + n) AS rate FROM ({rows}) m JOIN (
  SELECT up, CASE WHEN k < 2 THEN 10.0 WHEN between_ <= chance / 1000 THEN 1000.0 ELSE greatest(2.0, chance / between_ - 1) END AS strength FROM (
    SELECT {up} AS up, count(*) AS k, min(prior * (1 - prior)) AS chance,
           (sum(n * power(bad / n - prior, 2)) - (count(*) - 1) * min(prior * (1 - prior))) / greatest(sum(n) - sum(n * n) / sum(n), 1e-9) AS between_ FROM ({rows}) GROUP BY 1)) g ON g.up = m.{up})"""

_LABELLED = r"""SELECT lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host, l.toxic = 1 OR l.quality = 0 AS bad FROM pages
  JOIN labels l ON l.doc_id = TRY_CAST(nullif(regexp_extract(url, '://[^?#]*/([0-9]+)(\.html|/)?([?#]|$)', 1), '') AS BIGINT) WHERE (l.toxic = 1 OR l.quality = 0) IS NOT NULL"""

URLS = rf"""
WITH o AS ({_LABELLED}),
h AS (SELECT host, regexp_extract(host, '([^.]+\.[^.]+)$', 1) AS domain, regexp_extract(host, '([^.]+)$', 1) AS suffix, count(*)::DOUBLE AS n, count(*) FILTER (bad)::DOUBLE AS bad FROM o GROUP BY 1),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY 1, 2),
s AS (SELECT suffix, '*' AS everything, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 0.5) / (sum(n) + 1) FROM h) AS prior, 0.0 AS prior_var FROM d GROUP BY 1),
sr AS ({_SHRINK.format(rows="SELECT * FROM s", up="everything")}),
dr AS ({_SHRINK.format(rows="SELECT d.*, sr.rate AS prior, 0.0 AS prior_var, sr.rate AS expected FROM d JOIN sr USING (suffix)", up="suffix")}),
hr AS ({_SHRINK.format(rows="SELECT h.host, h.domain, h.n, h.bad, dr.rate AS prior, dr.var AS prior_var, dr.expected FROM h JOIN dr USING (domain)", up="domain")}),
blocked AS (SELECT host FROM hr WHERE rate - 2.326 * sqrt(var) > expected),
p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
f AS (SELECT *, CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1' WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
  WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/' WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/' WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END AS verdict FROM f
"""



def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII characters: a step for each byte and for each of its bits."""
    steps = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [ascii(substr({text}, i::INT, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295)"


TRIE = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS rn FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 9 AS h, conv_id - conv_id % 5 AS base FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS own, rn, role, text FROM c JOIN t ON t.conv_id = base AND rn <= h UNION ALL SELECT c.conv_id, 1, rn, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND rn > h),
s AS (SELECT c.conv_id, coalesce(list({{'r': role, 't': text}} ORDER BY own, rn) FILTER (role IS NOT NULL), []) AS said FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
p AS (SELECT conv_id, said, unnest(range(0, len(said) + 1)) AS depth FROM s),
n AS (SELECT said[1:depth] AS key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(said) = depth), '')) AS ends_sha256 FROM p GROUP BY ALL),
k AS (SELECT n.*, n.key[1:n.depth - 1] AS up, (n_convs - 1) * coalesce(strlen(key[depth].t), 0) AS own FROM n),
j AS (SELECT k.*, CASE WHEN k.depth > 0 THEN (SELECT any_value(u.conv_id) FROM n u WHERE u.depth = k.depth - 1 AND u.key = k.up) END AS parent_conv_id, (SELECT count(*) FROM k b WHERE b.depth = k.depth + 1 AND b.up = k.key) AS n_children FROM k)
SELECT a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children, count(*) FILTER (b.n_children = 0) AS n_leaves, sum(b.own)::BIGINT AS saved_tokens, a.ends_sha256
FROM j a JOIN j b ON b.key[1:a.depth] = a.key AND b.depth >= a.depth GROUP BY ALL
"""

EXACT = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256 FROM d WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST)
"""


def _edit(best: str, cost: str, edit: str) -> str:
    """A best pair, kept as nine digits of cost and then the audit, after one more edit."""
    return f"lpad((substr({best}, 1, 9)::INT + {cost})::VARCHAR, 9, '0') || substr({best}, 10) || '{edit}'"


REPAIR = rf"""
WITH RECURSIVE d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS k FROM conversations),
r AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy FROM d WHERE k <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM r),
q AS (SELECT *, NOT regexp_matches(text, '[^ 	-]') AS blank, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS duplicate, NOT blank AND NOT duplicate AND NOT regexp_matches(text, '[.!?][ 	-]*\z') AS truncated, left(role, 1) AS initial FROM o),
f AS (SELECT *, blank OR duplicate AS gone, CASE WHEN truncated THEN 5 ELSE 0 END AS worse, left(role, 1) || lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS pair FROM q),
-- the cheapest ways to be nowhere yet, after a system row, after a user's, after an assistant's
dp AS (SELECT DISTINCT conv_id, 0::BIGINT AS pos, '000000000' AS z, NULL::VARCHAR AS s, '000000005I' AS u, '000000010II' AS a FROM f
  UNION ALL SELECT conv_id, pos, z, s, u, least(a, {_edit("u", "5", "I")}) FROM (
  SELECT conv_id, pos, z, s, least(u, {_edit("z", "5", "I")}, {_edit("s", "5", "I")}, {_edit("a", "5", "I")}) AS u, a FROM (
  SELECT dp.conv_id, f.pos, {_edit("z", "2", "D")} AS z, least({_edit("s", "2", "D")}, CASE WHEN NOT gone AND initial = 's' THEN {_edit("z", "worse", "K")} END) AS s,
    least({_edit("u", "2", "D")}, CASE WHEN gone THEN NULL WHEN initial = 'u' THEN {_edit("least(z, s, a)", "worse", "K")} ELSE {_edit("least(z, s, a)", "worse + 1", "R")} END) AS u,
    least({_edit("a", "2", "D")}, CASE WHEN gone THEN NULL WHEN initial = 'a' THEN {_edit("u", "worse", "K")} ELSE {_edit("u", "worse + 1", "R")} END) AS a
  FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.pos = dp.pos + 1))),
b AS (SELECT conv_id, substr(arg_max(least(z, a), pos), 1, 9)::BIGINT AS cost, substr(arg_max(least(z, a), pos), 10) AS audit FROM dp GROUP BY conv_id),
e AS (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS i, substr(audit, i::INT, 1) AS edit FROM b),
w AS (SELECT *, count(*) FILTER (edit <> 'I') OVER x AS pos, count(*) FILTER (edit <> 'D') OVER x AS place FROM e WINDOW x AS (PARTITION BY conv_id ORDER BY i)),
y AS (SELECT w.conv_id, i, edit, place, role, text, max(CASE WHEN place = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY w.conv_id) AS off FROM w LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos AND edit <> 'I'),
h AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - off) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY i)) AS hash FROM y WHERE edit <> 'D' GROUP BY conv_id),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM c.conv_id
"""

SQL = {"op11_trie": TRIE, "op12_exact": EXACT, "op13_repair": REPAIR, "op5_embeddings": EMBEDDINGS, "op6_chat": CHATS, "op8_ngrams": NGRAMS, "op10_urls": URLS}
