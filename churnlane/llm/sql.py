"""DuckDB SQL for the training-data queries that SQL can express.

Token counts and piece ids (tokenizers), language ID (learned vectors),
sharding (64-bit hash draws) and runs (every period of every text is too much
for SQL) have none; tests/llm checks them by other means.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LINE_DEDUP = r"""
WITH line AS (
  SELECT doc_id, u.i AS line_no, u.l AS line,
         list_sort(list_distinct(regexp_extract_all(u.l, '[^\x20\x09-\x0D]+'))) AS ws
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
       LATERAL (SELECT unnest(ls) AS l, generate_subscripts(ls, 1) AS i) AS u),
sets AS (
  SELECT ws, row_number() OVER (ORDER BY min((doc_id, line_no))) AS rank, min((doc_id, line_no)) AS first
  FROM line WHERE len(ws) > 0 GROUP BY ws),
tok AS (SELECT rank, len(ws) AS n, unnest(ws) AS w FROM sets),
df AS (SELECT w, count(*) AS f FROM tok GROUP BY w),
pre AS (
  SELECT rank, n, w FROM (
    SELECT t.*, row_number() OVER (PARTITION BY t.rank ORDER BY f, t.w) AS p FROM tok t JOIN df USING (w))
  WHERE p <= n - ((3 * n + 3) // 4) + 1),
cand AS (
  SELECT DISTINCT a.rank AS ra, b.rank AS rb
  FROM pre a JOIN pre b ON a.w = b.w AND a.rank < b.rank AND 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)),
gone AS (
  SELECT DISTINCT rb AS rank
  FROM cand JOIN sets x ON x.rank = ra JOIN sets y ON y.rank = rb,
       LATERAL (SELECT len(list_intersect(x.ws, y.ws)) AS c)
  WHERE 4 * c >= 3 * (len(x.ws) + len(y.ws) - c)),
judged AS (
  SELECT l.*, len(l.ws) = 0 OR ((l.doc_id, l.line_no) = s.first AND g.rank IS NULL) AS keep
  FROM line l LEFT JOIN sets s USING (ws) LEFT JOIN gone g ON g.rank = s.rank)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT keep) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (keep), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

CHAT = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS k,
         coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
whole AS (
  SELECT conv_id, count(*) AS n, list((role, text) ORDER BY k) AS turns,
         string_agg('<|' || role || '|>' || chr(10) || text, chr(10) ORDER BY k) AS rendered
  FROM t GROUP BY conv_id),
one AS (SELECT turns, min(conv_id) AS conv_id, any_value(n) AS n_turns, count(*) AS n_copies,
               any_value(rendered) AS rendered FROM whole GROUP BY turns),
shorter AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, n)) AS k FROM whole))
SELECT conv_id, n_turns, n_copies, rendered FROM one WHERE turns NOT IN (SELECT turns FROM shorter)
"""

JACCARD = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_sort(list_distinct([array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)])) END AS s
  FROM w),
named AS (SELECT doc_id, len(s) AS n, CASE WHEN len(s) > 0 THEN md5(array_to_string(s, chr(10))) END AS sid, s FROM sets),
one AS (SELECT sid, min(doc_id) AS node, any_value(n) AS n, any_value(s) AS s FROM named WHERE n > 0 GROUP BY sid),
el AS (SELECT node, n, unnest(s) AS e FROM one),
link AS (
  SELECT a.node AS x, b.node AS y FROM el a JOIN el b ON a.e = b.e AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT x, y FROM edge UNION SELECT r.x, e.y FROM reach r JOIN edge e ON r.y = e.x),
comp AS (SELECT node, least(node, coalesce((SELECT min(y) FROM reach WHERE x = node), node)) AS c FROM one)
SELECT doc_id, n AS n_shingles, coalesce(c, doc_id) AS component_id
FROM named LEFT JOIN (SELECT sid, c FROM one JOIN comp USING (node)) USING (sid)
"""

DECONTAMINATION = rf"""
WITH item AS (SELECT item_id, {_ITEM_WORDS} AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(ws[i:i + 12], ' ') AS t, least(len(ws), 13) AS n
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM item WHERE len(ws) > 0)),
doc AS (SELECT doc_id, {_ITEM_WORDS} AS ws FROM documents),
size AS (SELECT DISTINCT n FROM win),
spot AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS t
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM doc, size)),
hit AS (SELECT s.doc_id, s.i, s.n, w.item_id FROM spot s JOIN win w ON s.t = w.t AND s.n = w.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SUBSTRING = rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS t
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
first AS (SELECT t, min(doc_id) AS d FROM win GROUP BY t),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN first USING (t) WHERE d < doc_id),
word AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t
         FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

MIXING = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS s,
         (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS w
  FROM doc GROUP BY source),
ratio AS (SELECT *, 3.0 * s / w AS r, sum(s) OVER () AS total FROM src),
run AS (  -- sources in the order in which they stop at three times their size
  SELECT *, coalesce(sum(3 * s) OVER before, 0) AS frozen, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open
  FROM ratio WINDOW before AS (ORDER BY r RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP)),
share AS (
  SELECT coalesce(min(total - frozen) FILTER (w * (total - frozen) / open <= 3 * s), NULL) AS left_words,
         arg_min(total - frozen, r) FILTER (w * (total - frozen) / open <= 3 * s) AS words,
         arg_min(open, r) FILTER (w * (total - frozen) / open <= 3 * s) AS weight
  FROM run),
goal AS (
  SELECT source, s AS source_size,
         CASE WHEN words IS NULL OR w * words / weight > 3 * s THEN 3.0 * s ELSE CAST(w * words AS DOUBLE) / weight END
           AS target
  FROM src, share),
draw AS (
  SELECT d.doc_id, d.source, d.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS ratio,
         (CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || CAST(size AS VARCHAR)), 1, 13)
            AS BIGINT) + 0.5) / 4503599627370496.0 AS u
  FROM doc d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
odds AS (
  SELECT *, least(floor(ratio), 3) AS sure, ratio - least(floor(ratio), 3) AS p,
         target - least(floor(ratio), 3) * source_size AS wanted,
         CASE WHEN ratio - least(floor(ratio), 3) <= 0 THEN CAST('inf' AS DOUBLE)
              ELSE (u / (1 - u)) / ((ratio - least(floor(ratio), 3)) / (1 - (ratio - least(floor(ratio), 3)))) END AS rank
  FROM draw),
upto AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id) <= wanted AS chosen FROM odds),
gap AS (SELECT source, any_value(wanted) - coalesce(sum(size) FILTER (chosen), 0) AS gap FROM upto GROUP BY source),
last AS (
  SELECT source, doc_id FROM (
    SELECT u.source, u.doc_id, row_number() OVER (PARTITION BY u.source ORDER BY size DESC, rank, u.doc_id DESC) AS n
    FROM upto u JOIN gap g ON u.source IS NOT DISTINCT FROM g.source
    WHERE NOT chosen AND size > 0 AND size <= gap AND rank < CAST('inf' AS DOUBLE))
  WHERE n = 1)
SELECT u.doc_id, size, source_size, target,
       CAST(size * least(sure + CASE WHEN p > 0 AND (chosen OR l.doc_id IS NOT NULL) THEN 1 ELSE 0 END, 3) AS BIGINT)
         AS taken
FROM upto u LEFT JOIN last l ON l.doc_id = u.doc_id AND l.source IS NOT DISTINCT FROM u.source
"""

QUALITY = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM documents),
gram AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c
  FROM (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w))),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
          SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM gram WHERE c > 1) GROUP BY doc_id),
base AS (
  SELECT doc_id, ws, ls, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words
       AND 100 * n_symbols <= 25 * n_words AND 100 * n_dup_lines <= 30 * len(ls)
       AND 100 * len(list_filter(ws, lambda x: NOT regexp_matches(x, '\p{{L}}'))) <= 40 * n_words
       AND len(list_filter(ws, lambda x: list_contains(string_split('{{stop}}', ' '), lower(x)))) > 0
       AND 100 * len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) <= 30 * len(ls)
       AS kept
FROM failed
""".replace("{stop}", "a and de der die el en et for from in is it la las le les los of que that the this to un und "
                      "une von was with y zu")

DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
occ AS (SELECT lang, source, t, count(*) AS n, count(DISTINCT row_no) AS docs
        FROM (SELECT row_no, lang, source, unnest(ts) AS t FROM d) GROUP BY ALL),
kept AS (SELECT lang, t, sum(n)::HUGEINT AS n FROM occ GROUP BY lang, t HAVING sum(docs) >= 10),
lang_size AS (SELECT lang, count(t)::HUGEINT AS v, coalesce(sum(n), 0)::HUGEINT AS total
              FROM (SELECT DISTINCT lang FROM g) LEFT JOIN kept USING (lang) GROUP BY lang),
grid AS (SELECT g.lang, g.source, k.t, coalesce(o.n, 0)::HUGEINT AS n, k.n AS lang_n
         FROM g JOIN kept k USING (lang) LEFT JOIN occ o ON o.lang = g.lang AND o.source = g.source AND o.t = k.t),
total AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM grid GROUP BY ALL),
p AS (SELECT lang, source, t, n,
             1 + (1000000000::HUGEINT * (n + 2)) // (x.total + 2 * z.v) AS p,
             1 + (1000000000::HUGEINT * (lang_n + 2)) // (z.total + 2 * z.v) AS q
      FROM grid JOIN total x USING (lang, source) JOIN lang_size z USING (lang)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pair x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
term AS (SELECT lang, source, 'term' AS part, t AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
         FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM term))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLE: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_chat_formatting": CHAT,
    "op4_ngram_jaccard_join": JACCARD,
    "op5_benchmark_decontamination": DECONTAMINATION,
    "op6_substring_dedup": SUBSTRING,
    "op8_mixing": MIXING,
    "op9_quality_rules": QUALITY,
    "op12_source_divergence": DIVERGENCE,
}
