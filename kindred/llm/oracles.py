"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from kindred.llm import license_join, line_frequency, positional_index, quality_ledger, url_equivalence

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACED = r"[^\x20\x09-\x0D]+"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

LINE_FREQUENCY = rf"""
WITH pages AS (SELECT doc_id, source AS host, text, row_number() OVER () AS rn FROM documents),
lines AS (
  SELECT rn, host, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM pages
),
boilerplate AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT rn) AS n FROM lines WHERE regexp_matches(line, '{_SPACED}') GROUP BY ALL)
  JOIN (SELECT host, count(*) AS total FROM pages GROUP BY host) USING (host)
  WHERE n >= {line_frequency.MIN_PAGES} AND n > {line_frequency.MAX_RATIO}::DOUBLE * total
),
judged AS (SELECT l.*, b.line IS NOT NULL AS bad FROM lines l LEFT JOIN boilerplate b ON l.host = b.host AND l.line = b.line),
per_page AS (
  SELECT rn, count(*) AS n_lines, count(*) FILTER (bad) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT bad), '') AS clean_text
  FROM judged GROUP BY rn
)
SELECT doc_id, host, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, clean_text FROM pages LEFT JOIN per_page USING (rn)
"""

_bits = " + ".join(f"CASE WHEN {r.fails.replace('D *', '::DOUBLE *')} THEN {1 << r.bit} ELSE 0 END" for r in quality_ledger.RULES)
_mask = quality_ledger.POLICIES[quality_ledger.POLICY]

QUALITY_LEDGER = rf"""
WITH w AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_SPACED}')) AS lines
  FROM documents
),
windows AS (SELECT rn, i, [words[i], words[i + 1], words[i + 2]] AS win FROM (SELECT rn, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, win) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rn, count(DISTINCT p) AS n FROM (SELECT rn, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rn),
m AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(lines) AS n_word_lines,
    len(list_filter(words, lambda x: regexp_full_match(x, '[A-Z][A-Z!.,?;:]{{2,}}'))) AS n_shouted
  FROM w LEFT JOIN covered USING (rn)
),
f AS (SELECT *, CAST({_bits} AS BIGINT) AS failure_bits FROM m)
SELECT *, (failure_bits & {quality_ledger.BASE_MASK}) <> 0 AS base_failed, (failure_bits & {_mask | quality_ledger.BASE_MASK}) = 0 AS kept,
  '{quality_ledger.POLICY}' AS policy FROM f
"""

_rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_equivalence.RULES)
_tag = lambda tag, attribute, value: rf"(?is)<{tag}\b[^>]*\b{attribute}\s*=\s*[\"'']?{value}\b[^>]*>"
_value = lambda name, end: rf"(?is)\b{name}\s*=\s*[\"'']?([^\"''\s>{end}]+)"

URL_EQUIVALENCE = rf"""
WITH RECURSIVE rules(rule_host, rule_path, rule_verdict) AS (VALUES {_rules}),
p AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
own AS (
  SELECT page_id, html, rest, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS node
  FROM p
),
found AS (
  SELECT host, path, node, unnest([regexp_extract(regexp_extract(html, '{_tag("link", "rel", "canonical")}'), '{_value("href", "")}', 1),
    regexp_extract(regexp_extract(html, '{_tag("meta", "http-equiv", "refresh")}'), '{_value("url", ";")}', 1)]) AS t
  FROM own WHERE host <> ''
),
whole AS (
  SELECT node, host, path, CASE WHEN contains(t, '://') THEN substr(t, instr(t, '://') + 3) WHEN starts_with(t, '//') THEN substr(t, 3) WHEN starts_with(t, '/') THEN host || t
    ELSE host || CASE WHEN regexp_replace(path, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END || t END AS rest
  FROM found WHERE t <> ''
),
links AS (
  SELECT node AS n1, host AS h1, path AS p1, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS h2, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS p2,
    translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS n2
  FROM whole
),
ends AS (SELECT n1 AS node, h1 AS host, p1 AS path FROM links WHERE h2 <> '' UNION SELECT n2, h2, p2 FROM links WHERE h2 <> ''),
reach(a, b) AS (
  SELECT node, node FROM ends
  UNION SELECT r.a, e.b FROM reach r JOIN (SELECT n1 AS a, n2 AS b FROM links WHERE h2 <> '' UNION SELECT n2, n1 FROM links WHERE h2 <> '') e ON r.b = e.a
),
places AS (SELECT DISTINCT host, path FROM own UNION SELECT host, path FROM ends),
ruled AS (
  SELECT host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule, max_by(rule_verdict, length(rule_host || rule_path)) AS own_verdict
  FROM places JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY ALL
),
told AS (
  SELECT a AS node, coalesce(bool_or(own_verdict = 'block'), false) AND NOT coalesce(bool_or(own_verdict = 'allow'), false) AS blocked
  FROM reach JOIN (SELECT node AS b, own_verdict FROM ends LEFT JOIN ruled USING (host, path)) USING (b) GROUP BY a
)
SELECT page_id, own.host, own.path, rule, coalesce(own_verdict, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict,
  own_verdict IS NULL AND coalesce(blocked, false) AS blocked_by_alias
FROM own LEFT JOIN ruled ON own.host = ruled.host AND own.path = ruled.path LEFT JOIN told ON own.node = told.node AND own.host <> ''
"""

_words = lambda text: f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}')"

POSITIONAL_INDEX = rf"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, {_words("text")} AS w FROM documents),
items AS (SELECT item_id, w, least({positional_index.WINDOW}, len(w)) AS m FROM (SELECT item_id, {_words("text")} AS w FROM benchmark) WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, m, w[i:i + m - 1] AS win FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM items)),
places AS (SELECT rn, i, m, w[i:i + m - 1] AS win FROM (SELECT rn, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM items))),
hits AS (SELECT rn, i, places.m, item_id FROM places JOIN wins ON places.m = wins.m AND places.win = wins.win),
covered AS (SELECT rn, count(DISTINCT p) AS n_hit FROM (SELECT rn, unnest(range(i, i + m)) AS p FROM hits) GROUP BY rn),
named AS (SELECT rn, list_sort(list_distinct(list(item_id::VARCHAR))) AS names FROM hits GROUP BY rn),
sized AS (SELECT row_number() OVER () AS item, w, least({positional_index.TERM}, len(w)) AS s FROM items),
terms AS (SELECT item, s, i AS place, w[i:i + s - 1] AS term, len(w) - s + 1 AS n FROM (SELECT *, unnest(range(1, len(w) - s + 2)) AS i FROM sized)),
shifts AS (
  SELECT rn, item, n, place, floor((i - place) / {positional_index.SLOP + 1}::DOUBLE)::BIGINT AS bin
  FROM (SELECT rn, i, s, w[i:i + s - 1] AS term FROM (SELECT rn, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM d, (SELECT DISTINCT s FROM sized))) JOIN terms USING (s, term)
),
close AS (
  SELECT DISTINCT rn, item FROM (SELECT rn, item, n, place, unnest([bin - 1, bin]) AS bin FROM shifts)
  GROUP BY rn, item, n, bin HAVING count(DISTINCT place) >= ceil({positional_index.NEAR_SHARE} * n - 1e-9)
),
near AS (SELECT rn, count(*) AS n_near FROM close GROUP BY rn)
SELECT coalesce(n_near, 0) AS n_near_items, doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(names), 0) AS n_items, sha256(coalesce(array_to_string(names, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {positional_index.SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (rn) LEFT JOIN named USING (rn) LEFT JOIN near USING (rn)
"""

_phrases = ", ".join(f"('{label}', {phrase.split()!r})" for phrase, label in license_join.PHRASES.items())
_stride = license_join.stride(license_join.TEMPLATES)
_templates = ", ".join(f"('{label}', {sorted(set(text.split()))!r})" for label, text in license_join.TEMPLATES)

LICENSE_JOIN = rf"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS text, {_words("text")} AS w FROM documents),
phrases(label, p) AS (VALUES {_phrases}),
templates(label, t) AS (VALUES {_templates}),
places AS (
  SELECT rn, label, i - 1 AS word
  FROM (SELECT rn, w, unnest(range(1, len(w) + 1)) AS i FROM d) JOIN phrases ON w[i] = p[1] WHERE w[i:i + len(p) - 1] = p
),
blocks AS (SELECT rn, list_distinct(w[i + 1:i + {2 * _stride}]) AS b FROM (SELECT rn, w, unnest(range(0, len(w), {_stride})) AS i FROM d)),
pairs AS (
  SELECT rn, label, len(list_intersect(b, t)) / len(t)::DOUBLE AS containment FROM blocks, templates
  WHERE len(list_intersect(b, t)) >= ceil(len(t) * {license_join.CONTAINMENT} - 1e-9)
),
base AS (SELECT rn, count(*) AS n_base, min(word) AS first_word, max(word) AS last_word, list_sort(list_distinct(list(label))) AS ls FROM places GROUP BY rn),
more AS (SELECT rn, list_distinct(list(label)) AS added, max(containment) AS best FROM pairs GROUP BY rn)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(ls, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(ls, []), coalesce(added, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base USING (rn) LEFT JOIN more USING (rn)
"""

HARD_NEGATIVES = r"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS parts
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
a AS (SELECT * FROM v WHERE vec_id % 100 = 0),
s AS (
  SELECT a.rid AS arid, a.vec_id AS anchor_id, v.rid, v.vec_id, v.label = a.label AS same, list_dot_product(a.parts, v.parts)::BIGINT AS score
  FROM a JOIN v ON a.rid <> v.rid
),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id NULLS LAST, rid) <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.arid, p.rid ORDER BY s.score DESC, s.vec_id NULLS LAST, s.rid)::INTEGER AS rank
  FROM p JOIN s ON s.arid = p.arid AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

ORACLES = {
    "op1_line_frequency": LINE_FREQUENCY,
    "op2_quality_ledger": QUALITY_LEDGER,
    "op4_url_equivalence": URL_EQUIVALENCE,
    "op6_positional_index": POSITIONAL_INDEX,
    "op10_license_join": LICENSE_JOIN,
    "op12_hard_negatives": HARD_NEGATIVES,
}
