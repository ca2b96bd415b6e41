"""DuckDB SQL for the digest queries, in other words than the operators'."""

_BLANK = r"[\x20\x09-\x0D]"

_WORDS = rf"list_filter(regexp_split_to_array(coalesce(text, ''), '{_BLANK}+'), lambda x: x <> '')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _tokens(column: str) -> str:
    return rf"list_filter(regexp_split_to_array(translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


OP1 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, text, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
),
starts AS (
  SELECT rid, p, list_aggregate(w[p:p + 7], 'string_agg', ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS p FROM d WHERE len(w) >= 8)
),
again AS (
  SELECT DISTINCT rid, p + k AS q
  FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS n FROM starts), (SELECT unnest(range(0, 8)) AS k)
  WHERE n > 1
),
repeats AS (SELECT rid, count(*) AS n FROM again GROUP BY rid),
lines AS (
  SELECT rid, source, text, trim(regexp_replace(lower(x), '{_BLANK}+', ' ', 'g')) AS line,
         len(list_filter(regexp_split_to_array(x, '{_BLANK}+'), lambda y: y <> '')) AS n
  FROM (SELECT rid, source, text, unnest(l) AS x FROM d)
),
hosts AS (SELECT source, count(DISTINCT coalesce('1' || text, '0')) AS n FROM documents GROUP BY source),
hot AS (
  SELECT l.source, line FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
  GROUP BY l.source, line, h.n HAVING count(DISTINCT text) >= 20 AND count(DISTINCT text) >= h.n * 0.005
),
removed AS (
  SELECT rid, sum(n) AS n FROM lines JOIN hot ON lines.source IS NOT DISTINCT FROM hot.source AND lines.line = hot.line GROUP BY rid
),
f AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
         coalesce(removed.n, 0)::BIGINT AS n_removed_words
  FROM d LEFT JOIN repeats USING (rid) LEFT JOIN removed USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed, n_removed_words,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - n_removed_words >= n_words * 0.5 AS kept
FROM f
"""

OP5 = rf"""
WITH s AS (
  SELECT doc_id, text, coalesce('0' || source, '1') AS skey, len({_WORDS})::BIGINT AS size FROM documents
),
src AS (SELECT skey, sum(size)::BIGINT AS source_size, count(*) AS docs FROM s GROUP BY skey),
weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY skey) - 1) % 3) + 1] AS weight, source_size * 2 AS cap FROM src
),
-- The level is the least at which capped shares add up to the goal; it lies
-- where the sources below their cap are those of more size per weight.
tried AS (
  SELECT a.skey, (((SELECT sum(source_size) FROM src) * 150 / 100)
          - coalesce((SELECT sum(b.cap) FROM weighed b WHERE (b.cap / b.weight, b.skey) < (a.cap / a.weight, a.skey)), 0)::DOUBLE)
         / (SELECT sum(b.weight) FROM weighed b WHERE (b.cap / b.weight, b.skey) >= (a.cap / a.weight, a.skey))::DOUBLE AS level,
         a.cap / a.weight AS edge
  FROM weighed a
),
open AS (SELECT arg_min(level, (edge, skey)) AS level FROM tried WHERE edge > level),
targets AS (
  SELECT skey, source_size, docs, CASE WHEN cap <= t.level * weight THEN cap::DOUBLE ELSE weight * (SELECT level FROM open) END AS target
  FROM weighed JOIN tried t USING (skey)
),
placed AS (
  SELECT s.*, t.source_size, t.target,
         lpad(length(bin(size))::VARCHAR, 2, '0') || substr(bin(size), 2, 2) AS class,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/17/' || md5(coalesce(text, ''))), 1, 8))::BIGINT % ceil(count(*) OVER (PARTITION BY skey, class) / 500.0)::BIGINT AS block
  FROM s JOIN targets t USING (skey)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY skey ORDER BY class, block, size, doc_id NULLS FIRST, md5(coalesce(text, ''))) AS k FROM placed),
rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5(skey || '#17'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM ranked
)
SELECT doc_id, size, source_size, target,
       (floor(u + rate * k) - floor(u + rate * (k - 1)))::BIGINT AS copies,
       ((floor(u + rate * k) - floor(u + rate * (k - 1))) * size)::BIGINT AS taken
FROM rated
"""

OP7 = r"""
WITH u AS (
  SELECT row_number() OVER () AS rid, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
),
p AS (
  SELECT rid, page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM u
),
rules(host, path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
),
fit AS (
  SELECT p.rid, p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict
  FROM p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict
FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC NULLS LAST, rule DESC, verdict DESC) AS rn FROM fit) WHERE rn = 1
"""

OP8 = rf"""
WITH d AS (SELECT doc_id, {_tokens("text")} AS w FROM documents),
b AS (SELECT item_id, {_tokens("text")} AS w FROM benchmark),
items AS (SELECT item_id, w, least(len(w), 10) AS m FROM b WHERE len(w) > 0),
grams AS (
  SELECT DISTINCT item_id, m, list_aggregate(w[p:p + m - 1], 'string_agg', ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS p FROM items)
),
cuts AS (
  SELECT doc_id, m, p, list_aggregate(w[p:p + m - 1], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, (SELECT DISTINCT m FROM grams) WHERE len(w) >= m)
),
hits AS (SELECT c.doc_id, c.p, c.m, g.item_id FROM cuts c JOIN grams g ON c.m = g.m AND c.g = g.g),
words AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP9 = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         length(role) + length(regexp_replace(role, '[^\\<>]', '', 'g')) + length(text) + length(regexp_replace(text, '[^\\<>]', '', 'g'))
           + length('<turn >') + length('</turn>') + 1 AS chars, ceil(chars / 4.0)::BIGINT AS size
  FROM raw
),
p AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY k)::BIGINT AS upto FROM t),
room AS (
  SELECT conv_id, CASE WHEN role = 'system' THEN 1 ELSE 0 END AS n_system,
         greatest(1, 1024 - 256 - CASE WHEN role = 'system' THEN size ELSE 0 END) AS room
  FROM t WHERE k = 1
),
cut(conv_id, k, start, base, limit_) AS (
  SELECT conv_id, 1::BIGINT, 1::BIGINT, 0::BIGINT, 1024::BIGINT FROM room
  UNION ALL
  SELECT c.conv_id, p.k,
         CASE WHEN p.upto - c.base <= c.limit_ THEN c.start ELSE p.k END,
         CASE WHEN p.upto - c.base <= c.limit_ THEN c.base ELSE p.upto - p.size END,
         CASE WHEN p.upto - c.base <= c.limit_ THEN c.limit_ ELSE r.room END
  FROM cut c JOIN p ON p.conv_id = c.conv_id AND p.k = c.k + 1 JOIN room r ON r.conv_id = c.conv_id
),
starts AS (SELECT DISTINCT conv_id, start, base FROM cut WHERE start > 1),
repeats AS (
  SELECT s.conv_id, sum(p.chars) AS chars
  FROM starts s JOIN room r USING (conv_id) JOIN p ON p.conv_id = s.conv_id AND p.k < s.start
  WHERE p.k <= r.n_system OR s.base - (p.upto - p.size) <= 256
  GROUP BY s.conv_id
),
whole AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
         coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
         sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
         sum(chars) AS chars
  FROM t GROUP BY conv_id
)
SELECT w.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, (w.chars + coalesce(r.chars, 0))::BIGINT AS formatted_chars
FROM whole w LEFT JOIN repeats r ON r.conv_id = w.conv_id
"""

SQL = {"op1_quality_rules": OP1, "op5_mixing": OP5, "op7_url_rules": OP7, "op8_decontaminate": OP8, "op9_chat_format": OP9}
