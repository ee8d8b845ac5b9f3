"""DuckDB SQL for those queries that SQL can express; the others are tested against brute force (tests/llm)."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP2 = r"""
WITH urls AS (
  SELECT page_id, url, 1704067200 + 60 * CAST('0x' || substr(md5('t' || page_id), 1, 4) AS BIGINT) AS fetched_at,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)) AS h,
         nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+/([^/?#]+)', 1), '') AS head
  FROM pages),
captures AS (SELECT *, CASE WHEN length(h) <= 253 THEN nullif(regexp_replace(h, '\.$', ''), '') END AS host FROM urls),
keys AS (
  SELECT page_id, unnest(list_transform(range(1, CASE WHEN regexp_matches(host, '^[0-9.]+$') THEN 2 ELSE greatest(len(string_split(host, '.')), 2) END), lambda i: array_to_string(list_slice(string_split(host, '.'), i, 999), '.'))) AS entry FROM captures WHERE host IS NOT NULL
  UNION SELECT page_id, host || '/' || head FROM captures WHERE host IS NOT NULL AND head IS NOT NULL),
names AS (SELECT DISTINCT entry FROM keys),
numbered AS (
  SELECT entry, CAST('0x' || substr(md5('l' || entry), 1, 4) AS BIGINT) AS a, CAST('0x' || substr(md5('l' || entry), 5, 4) AS BIGINT) AS b,
         CAST('0x' || substr(md5('l' || entry), 9, 4) AS BIGINT) AS c, CAST('0x' || substr(md5('l' || entry), 13, 4) AS BIGINT) AS d
  FROM names),
entries AS (
  SELECT entry, 1704067200 + 60 * b AS valid_from, CASE WHEN d < 49152 THEN 1704067200 + 60 * (b + c) END AS valid_to
  FROM numbered WHERE a < 32768 AND NOT (d < 49152 AND c = 0)),
hits AS (
  SELECT k.page_id, k.entry FROM keys k JOIN captures c ON k.page_id = c.page_id JOIN entries e ON k.entry = e.entry AND c.fetched_at >= e.valid_from AND (e.valid_to IS NULL OR c.fetched_at < e.valid_to))
SELECT c.page_id, c.url, c.fetched_at, count(h.entry) > 0 AS blocked, count(DISTINCT h.entry) AS n_entries, min(h.entry) AS entry
FROM captures c LEFT JOIN hits h ON c.page_id = h.page_id GROUP BY c.page_id, c.url, c.fetched_at
"""


def _level(name: str, parent: list[str], cases: str, share: str) -> str:
    path = [*parent, name]
    keys, part = ", ".join(path), f"PARTITION BY {', '.join(parent)}" if parent else ""
    join = f"JOIN b{len(parent)} USING ({', '.join(parent)})" if parent else f"CROSS JOIN (SELECT least((sum(tokens) * {share}) , sum(tokens) * 3)::HUGEINT AS budget FROM leaves)"
    return f"""
n{len(path)} AS (SELECT {keys}, sum(tokens)::HUGEINT AS tokens, sum(tokens * 3)::HUGEINT AS room, ({cases})::HUGEINT AS w FROM leaves GROUP BY {keys}),
o{len(path)} AS (
  SELECT *, coalesce(sum(room) OVER ({part} ORDER BY room::DECIMAL(38, 9) / w, {keys} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS used,
         sum(w) OVER ({part} ORDER BY room::DECIMAL(38, 9) / w, {keys} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS open_w
  FROM n{len(path)} {join} WHERE w > 0),
f{len(path)} AS (SELECT *, room * open_w + used * w <= budget * w AS is_full FROM o{len(path)}),
g{len(path)} AS (
  SELECT *, coalesce(sum(CASE WHEN is_full THEN room END) OVER ({part}), 0)::HUGEINT AS filled, coalesce(sum(CASE WHEN NOT is_full THEN w END) OVER ({part}), 0)::HUGEINT AS weight_left FROM f{len(path)}),
h{len(path)} AS (SELECT *, CASE WHEN is_full THEN room ELSE (w * (budget - filled)) // greatest(weight_left, 1) END AS share, row_number() OVER ({part} ORDER BY CASE WHEN is_full THEN -1 ELSE (w * (budget - filled)) % greatest(weight_left, 1) END DESC, {keys}) AS place FROM g{len(path)}),
b{len(path)} AS (SELECT {keys}, {"tokens, " if len(path) == 3 else ""}(share + CASE WHEN NOT is_full AND place <= budget - sum(share) OVER ({part}) THEN 1 ELSE 0 END)::HUGEINT AS budget FROM h{len(path)})"""


_OP3 = f"""
WITH rows AS (
  SELECT doc_id, text, coalesce('d' || length(source), '') AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source, len({_WORDS}) AS tokens
  FROM documents WHERE len({_WORDS}) > 0),
leaves AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS tokens FROM rows GROUP BY ALL),
{_level("domain", [], "CASE domain WHEN 'd5' THEN 2 ELSE 1 END", "6 // 10").strip()},
{_level("lang", ["domain"], "CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END", "").strip()},
{_level("source", ["domain", "lang"], "1", "").strip()},
dealt AS (SELECT r.*, (b3.budget // b3.tokens)::INT AS epochs, (b3.budget % b3.tokens)::BIGINT AS rest FROM rows r JOIN b3 ON r.domain = b3.domain AND r.lang = b3.lang AND r.source = b3.source),
prefixed AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('17|' || epochs || '|' || coalesce(doc_id::VARCHAR, '')) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM dealt)
SELECT doc_id, domain, lang, source, unnest(range(epochs))::INT AS epoch, tokens::BIGINT AS tokens, tokens::BIGINT AS n_taken FROM dealt
UNION ALL
SELECT doc_id, domain, lang, source, epochs AS epoch, tokens::BIGINT, least(tokens, rest - start)::BIGINT FROM prefixed WHERE start < rest
""".replace("sum(tokens) * 6 // 10", "(sum(tokens) * 6) // 10")

_BIN = "CASE WHEN {0} < 32 THEN {0} ELSE 32 * (length(bin({0})) - 5) + ({0} >> (length(bin({0})) - 6)) - 32 END"
_FLOOR = "CASE WHEN {0} < 32 THEN {0} ELSE ({0} - 32 * ({0} // 32) + 32) << ({0} // 32 - 1) END"


def _quantile(q: int | str) -> str:
    return f"min(CASE WHEN upto >= size // 1000 * {q} + size % 1000 * {q} // 1000 THEN bin END)"


_OP7 = rf"""
WITH w AS (SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
win AS (SELECT row, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS g FROM (SELECT row, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
twice AS (SELECT row, g FROM win GROUP BY row, g HAVING count(*) > 1),
covered AS (SELECT row, count(*) AS n FROM (SELECT DISTINCT row, unnest(range(i, i + 5)) AS at FROM win JOIN twice USING (row, g)) GROUP BY row),
f AS (
  SELECT w.*, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS ls, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(covered.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN covered ON w.row = covered.row),
d AS (
  SELECT row, doc_id, lang, source, n_words, word_chars, n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         1000 * n_symbols // greatest(n_words, 1) AS symbols, 1000 * (len(ls) - len(list_distinct(ls))) // greatest(len(ls), 1) AS dup_lines, 1000 * n_repeat_words // greatest(n_words, 1) AS repeats, 1000 * word_chars // greatest(n_words, 1) AS word_length FROM f),
v AS (UNPIVOT d ON symbols, dup_lines, repeats, word_length INTO NAME rule VALUE value),
s AS (SELECT lang, source, rule, {_BIN.format("value")} AS bin, count(*) AS n FROM v WHERE NOT base_failed GROUP BY ALL),
g AS (SELECT DISTINCT lang, source, rule FROM s),
l AS (SELECT lang, rule, bin, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang, rule) AS size FROM s GROUP BY lang, rule, bin),
a AS (SELECT rule, bin, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY rule) AS size FROM s GROUP BY rule, bin),
m AS (
  SELECT lang, source, rule, bin, sum(weight) AS weight FROM (
    SELECT lang, source, rule, bin, n * 65536 AS weight FROM s
    UNION ALL SELECT g.lang, g.source, g.rule, l.bin, (50 * 65536 * l.n) // l.size FROM g JOIN l ON g.lang IS NOT DISTINCT FROM l.lang AND g.rule = l.rule
    UNION ALL SELECT g.lang, g.source, g.rule, a.bin, (50 * 65536 * a.n) // a.size FROM g JOIN a ON g.rule = a.rule) GROUP BY lang, source, rule, bin),
u AS (SELECT *, sum(weight) OVER (PARTITION BY lang, source, rule ORDER BY bin) AS upto, sum(weight) OVER (PARTITION BY lang, source, rule) AS size FROM m),
q AS (SELECT lang, source, rule, {_quantile("(1000 - tail)")}::BIGINT AS b0, {_quantile(250)}::BIGINT AS b1, {_quantile(750)}::BIGINT AS b3, {_quantile("tail")}::BIGINT AS b9 FROM (SELECT *, CASE rule WHEN 'symbols' THEN 900 ELSE 990 END AS tail FROM u) GROUP BY lang, source, rule),
p AS (SELECT lang, source, rule, {_FLOOR.format("b0")} AS q0, {_FLOOR.format("b1")} AS q1, {_FLOOR.format("b3")} AS q3, {_FLOOR.format("(b3 + 1)")} - 1 AS t3, {_FLOOR.format("(b9 + 1)")} - 1 AS t9 FROM q),
bad AS (
  SELECT DISTINCT v.row FROM v JOIN p ON v.rule = p.rule AND v.lang IS NOT DISTINCT FROM p.lang AND v.source IS NOT DISTINCT FROM p.source
  WHERE v.value > greatest(t3 + 4 * (q3 - q1), t9) OR (v.rule = 'word_length' AND v.value < least(q1 - 4 * (q3 - q1), q0)))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.row IS NULL AS kept FROM d LEFT JOIN bad ON d.row = bad.row
"""

_OP8 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", _LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(list_slice(ws, i, i + 2), ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle,
         len(ws) >= 3 AS whole FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.shingle = b.shingle AND a.whole = b.whole AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 100 * o >= 90 * (x.n + y.n - o)),
pairs AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM w UNION SELECT reach.doc_id, pairs.b FROM reach JOIN pairs ON reach.r = pairs.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r) AS component_id FROM w JOIN reach ON w.doc_id = reach.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id, n.n
"""

_OP9 = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
g AS (SELECT doc_id, unnest(range(1, greatest(len(ws) - 11, 1))) AS i, ws FROM w),
x AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS win FROM g),
f AS (SELECT win, min(doc_id) AS d FROM x GROUP BY win),
gone AS (SELECT DISTINCT x.doc_id, unnest(range(x.i, x.i + 13)) AS i FROM x JOIN f USING (win) WHERE f.d < x.doc_id),
k AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(r.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(r.kept, '')) AS kept_sha256
FROM w LEFT JOIN (
  SELECT k.doc_id, count(gone.i) AS n_removed, string_agg(k.word, ' ' ORDER BY k.i) FILTER (WHERE gone.i IS NULL) AS kept
  FROM k LEFT JOIN gone ON gone.doc_id = k.doc_id AND gone.i = k.i GROUP BY k.doc_id) r ON r.doc_id = w.doc_id
"""

_OP10 = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS line_key FROM l),
b AS (SELECT line_key AS often FROM k WHERE length(line_key) >= 1 GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(often)::BIGINT AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE often IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN b ON k.line_key = b.often GROUP BY doc_id
"""

_OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
marks AS (SELECT doc_id, coalesce(max(quality), 0) = 1 AS good, coalesce(max(toxic), 0) = 1 AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n,
         list_concat(CASE WHEN len(ws) < 100 THEN ['A'] ELSE [] END, CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN ['B'] ELSE [] END,
                     CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN ['C'] ELSE [] END, CASE WHEN regexp_matches(text, '[#$%&*|]') THEN ['D'] ELSE [] END,
                     CASE WHEN doc_id > first THEN ['E'] ELSE [] END) AS fails
  FROM d JOIN firsts USING (text) LEFT JOIN marks USING (doc_id) GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT o, unnest(range(1, 6)) AS step FROM o),
p AS (SELECT DISTINCT part FROM m),
r AS (
  SELECT p.part, array_to_string(o, '') AS filter_order, step::INT AS step, o[step] AS filter,
         sum(n) FILTER (WHERE NOT list_has_any(fails, o[1:step])) AS kept, sum(n) FILTER (WHERE list_contains(fails, o[step]) AND NOT list_has_any(fails, o[1:step - 1])) AS removed,
         sum(n) FILTER (WHERE list_contains(fails, o[step]) AND list_has_any(fails, o[1:step - 1])) AS redundant, sum(n) FILTER (WHERE fails = [o[step]]) AS unique_fails,
         sum(n) FILTER (WHERE good AND list_contains(fails, o[step]) AND NOT list_has_any(fails, o[1:step - 1])) AS good_lost,
         sum(n) FILTER (WHERE toxic AND list_contains(fails, o[step]) AND NOT list_has_any(fails, o[1:step - 1])) AS toxic_lost
  FROM p, s JOIN m ON m.part = p.part GROUP BY p.part, o, step)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, filter), 0)::BIGINT AS shapley FROM r
"""

ORACLES = {"op2_url_filter": _OP2, "op3_source_mixing": _OP3, "op7_quality_rules": _OP7, "op8_jaccard_join": _OP8, "op9_substring_dedup": _OP9, "op10_line_dedup": _OP10, "op13_filter_audit": _OP13}
