"""DuckDB SQL of the conversation operators."""

from __future__ import annotations


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text expression, bit by bit."""
    step = "list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {step}), 4294967295::BIGINT)"


_WORDS = r"len(regexp_extract_all({0}, '[^\x20\x09-\x0D]+'))"
_CODE = "sha256(length(role) || chr(10) || role || chr(10) || text)"

TRIE = f"""
WITH o AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_CODE}) AS place FROM o),
ids AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {crc32('CAST(conv_id AS VARCHAR)')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM o)),
s AS (SELECT ids.conv_id, 0 AS part, n.place, n.role, n.text FROM ids JOIN n ON n.conv_id = ids.base AND n.place <= h
  UNION ALL SELECT ids.conv_id, 1, n.place, n.role, n.text FROM ids JOIN n ON n.conv_id = ids.conv_id AND n.place > h),
t AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth,
  string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY part, place) AS prefix FROM s),
p AS (SELECT conv_id, depth, md5(prefix) AS node, {_WORDS.format('text')} AS words FROM t
  UNION ALL SELECT conv_id, 0, '', 0 FROM ids),
l AS (SELECT conv_id, MAX(depth) AS len FROM p GROUP BY conv_id),
g AS (SELECT node, MIN(p.conv_id) AS conv_id, MIN(depth) AS depth, COUNT(*) AS n_convs, MIN(words) AS words,
  string_agg(CASE WHEN l.len = depth THEN CAST(p.conv_id AS VARCHAR) END, ',' ORDER BY p.conv_id) AS ends
  FROM p JOIN l ON l.conv_id = p.conv_id GROUP BY node),
up AS (SELECT g.*, q.node AS parent FROM g LEFT JOIN p q ON q.conv_id = g.conv_id AND q.depth = g.depth - 1),
kids AS (SELECT parent, COUNT(*) AS n FROM up WHERE parent IS NOT NULL GROUP BY parent),
full_ AS (SELECT up.*, COALESCE(kids.n, 0) AS n_children FROM up LEFT JOIN kids ON kids.parent = up.node),
sums AS (SELECT a.node, COUNT(*) FILTER (WHERE f.n_children = 0) AS n_leaves, SUM((f.n_convs - 1) * f.words) AS saved
  FROM full_ f JOIN p a ON a.conv_id = f.conv_id AND a.depth <= f.depth GROUP BY a.node)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, pg.conv_id AS parent_conv_id, f.n_convs, f.n_children, sums.n_leaves,
 CAST(sums.saved AS BIGINT) AS saved_tokens, sha256(COALESCE(f.ends, '')) AS ends_sha256
FROM full_ f JOIN sums ON sums.node = f.node LEFT JOIN g pg ON pg.node = f.parent"""

_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_ID = "COALESCE(CAST({0} AS VARCHAR), ' ')"
#: States of s? (u a)+: 0 nothing, 1 after s, 2 after u, 3 after a.
REPAIR = f"""
WITH RECURSIVE c AS (SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
  {crc32(_ID.format('conv_id') + " || ':' || " + _ID.format('turn'))} % 20 AS fate FROM conversations),
ids AS (SELECT conv_id, ROW_NUMBER() OVER () AS k FROM (SELECT DISTINCT conv_id FROM c)),
e AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
  CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM c),
r AS (SELECT ids.k, e.*, ROW_NUMBER() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, {_CODE}, copy) AS i
  FROM e JOIN ids ON ids.conv_id IS NOT DISTINCT FROM e.conv_id),
f AS (SELECT *, CASE WHEN rtrim(text, {_SPACES}) = '' THEN 1
   WHEN ROW_NUMBER() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 2
   WHEN right(rtrim(text, {_SPACES}), 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
  LAG(left(role, 1)) OVER (PARTITION BY k ORDER BY i) || left(role, 1) AS pair FROM r),
st AS (SELECT k, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) AS n,
  COUNT(*) FILTER (WHERE fault = 1) AS blank, COUNT(*) FILTER (WHERE fault = 2) AS duplicate,
  COUNT(*) FILTER (WHERE fault = 3) AS truncated, COUNT(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY k),
ins(s, t, x, price) AS (VALUES (0, 0, '', 0), (0, 2, 'I', 3), (0, 3, 'II', 6), (1, 1, '', 0), (1, 2, 'I', 3), (1, 3, 'II', 6),
  (2, 2, '', 0), (2, 3, 'I', 3), (3, 3, '', 0), (3, 2, 'I', 3)),
mv(s, y, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
act AS (SELECT s, t, 'K' AS a, y, 0 AS price FROM mv UNION ALL SELECT s, t, 'R', NULL, 3 FROM mv WHERE y <> 's'
  UNION ALL SELECT s, s, 'D', NULL, 4 FROM (VALUES (0), (1), (2), (3)) v(s)),
dp AS (SELECT k, 0::BIGINT AS i, 0 AS s, {{'cost': 0::BIGINT, 'audit': ''}} AS best FROM ids
  UNION ALL
  SELECT dp.k, dp.i + 1, act.t, MIN({{'cost': best.cost + ins.price + act.price + CASE WHEN act.a <> 'D' AND f.fault = 3 THEN 3 ELSE 0 END,
    'audit': best.audit || ins.x || act.a}})
  FROM dp JOIN f ON f.k = dp.k AND f.i = dp.i + 1 JOIN ins ON ins.s = dp.s JOIN act ON act.s = ins.t
  WHERE (act.a = 'D' OR f.fault NOT IN (1, 2)) AND (act.y IS NULL OR act.y = left(f.role, 1))
  GROUP BY dp.k, dp.i, act.t),
fin AS (SELECT dp.k, MIN({{'cost': best.cost + ins.price, 'audit': best.audit || ins.x}}) AS best
  FROM dp LEFT JOIN st ON st.k = dp.k JOIN ins ON ins.s = dp.s WHERE dp.i = COALESCE(st.n, 0) AND ins.t IN (0, 3) GROUP BY dp.k),
ed AS (SELECT k, unnest(string_split(best.audit, '')) AS a, generate_subscripts(string_split(best.audit, ''), 1) AS j FROM fin WHERE best.audit <> ''),
rd AS (SELECT *, COUNT(*) FILTER (WHERE a <> 'I') OVER (PARTITION BY k ORDER BY j) AS i FROM ed),
ot AS (SELECT rd.k, rd.a, f.role, f.text, ROW_NUMBER() OVER (PARTITION BY rd.k ORDER BY rd.j) AS j
  FROM rd LEFT JOIN f ON f.k = rd.k AND f.i = rd.i AND rd.a <> 'I' WHERE rd.a <> 'D'),
lead_ AS (SELECT *, MAX(CASE WHEN j = 1 AND a = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY k) AS led FROM ot),
tx AS (SELECT k, string_agg(CASE WHEN a = 'K' THEN role WHEN (j - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || COALESCE(text, ''),
  chr(10) ORDER BY j) AS t FROM lead_ GROUP BY k)
SELECT ids.conv_id, CAST(COALESCE(gaps, 0) AS BIGINT) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate,
 COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal, CAST(fin.best.cost AS BIGINT) AS cost, fin.best.audit AS audit,
 sha256(COALESCE(tx.t, '')) AS repaired_sha256
FROM ids JOIN fin ON fin.k = ids.k LEFT JOIN st ON st.k = ids.k LEFT JOIN tx ON tx.k = ids.k"""

#: Escapes written by the pattern, without a round trip.
_SQL_ESCAPED = r"regexp_replace(regexp_replace({0}, '(\[\\*)(/?INST\]|/?TURN\]|SAYS\])', '\1\\\2', 'g'), '(<\\*)(</?SYS>>|/s>)', '\1\\\2', 'g')"

CHAT = f"""
WITH r AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1::BIGINT, 0::BIGINT, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
p AS (SELECT *, CASE role WHEN 'user' THEN '[INST]' || {_SQL_ESCAPED.format('text')} || '[/INST]'
  WHEN 'system' THEN '<<SYS>>' || {_SQL_ESCAPED.format('text')} || '<</SYS>>'
  WHEN 'assistant' THEN {_SQL_ESCAPED.format('text')} || '</s>'
  ELSE '[TURN]' || {_SQL_ESCAPED.format('role')} || '[SAYS]' || {_SQL_ESCAPED.format('text')} || '[/TURN]' END AS piece FROM r)
SELECT conv_id, COUNT(*) AS n_turns,
 sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, piece)) AS turns_sha256,
 CAST(COALESCE(SUM(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, piece) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
 CAST(SUM(length(piece)) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id"""
