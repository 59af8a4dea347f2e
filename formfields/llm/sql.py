"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from . import url_filters as U
from .quality_rules import STOP_WORDS, THRESHOLDS
from .secrets import ACCESS, ASSIGN, ENDPOINT, HEX, KEY
from .url_filters import URL_RULES

WORD = "[^\\x20\\x09-\\x0D]+"

OP4 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS g FROM d
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
-- Only shingles of two documents or more can be in an overlap; one document of equal ones is enough as a start.
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * same >= 75 * (x.n + y.n - same)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS node, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.root, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT node, min(root) AS root FROM r GROUP BY node) m ON m.node = d.doc_id
"""


def _spans(kind: str, rank: int, pattern: str, test: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT rn, '{kind}' AS kind, {rank} AS k, s, s + length(m) AS e FROM (
    SELECT rn, found[i] AS m, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS s
    FROM (SELECT rn, gaps, found, unnest(range(1, len(found) + 1)) AS i FROM (SELECT rn, string_split_regex(t, '{quoted}') AS gaps, regexp_extract_all(t, '{quoted}') AS found FROM d))
  ) WHERE {test.replace("PATTERN", quoted)}"""


OP5 = f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM documents),
strong AS ({_spans("assign", 0, ASSIGN, "length(regexp_extract(m, '^PATTERN', 2)) >= 6")}
  UNION ALL {_spans("access", 1, ACCESS, "true")}
  UNION ALL {_spans("hex", 2, HEX, "true")}),
weak AS ({_spans("key", 3, KEY, "regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]')")}
  UNION ALL {_spans("endpoint", 4, ENDPOINT.replace("?:", ""), "true")}),
other AS (SELECT * FROM strong UNION ALL SELECT * FROM weak WHERE k = 3),
linked AS (
  SELECT w.rn, w.kind, w.k, w.s, w.e FROM weak w JOIN other o ON o.rn = w.rn AND o.s - w.e <= 300 AND w.s - o.e <= 300 AND NOT (o.s = w.s AND o.e = w.e)
  GROUP BY ALL HAVING max(CAST(o.k = 1 AS INT)) = 1 AND (w.k = 3 OR max(CAST(o.k IN (0, 2, 3) AS INT)) = 1)),
listed AS (SELECT rn, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS base, count(*) FILTER (k = 0) AS c0, count(*) FILTER (k = 1) AS c1, count(*) FILTER (k = 2) AS c2 FROM strong GROUP BY rn),
whole AS (SELECT rn, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS spans, count(*) FILTER (k > 2) AS c3 FROM (SELECT * FROM strong UNION ALL SELECT * FROM linked) GROUP BY rn)
SELECT doc_id, coalesce(c0, 0) AS n_assign, coalesce(c1, 0) AS n_access, coalesce(c2, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(c3, 0) AS n_weak
FROM d LEFT JOIN listed USING (rn) LEFT JOIN whole USING (rn)
"""

OP6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, upper(sha1(h)) AS hex, h FROM p),
b AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 8), lambda k:
    list_reduce(list_transform([32768, 1024, 32, 1], lambda q: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(hex, 5 * k + 1, 5) AS BIGINT) // q) % 32 AS INT) + 1, 1)), lambda a, c: a || c)), '') AS payload_digest
  FROM x),
l AS (SELECT payload_digest, max(page_id) AS last FROM b GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM b JOIN l USING (payload_digest)
"""


def _bounds() -> str:
    tests = [t for metric, low, high in THRESHOLDS for t in ([f"{metric} >= {low}"] if low is not None else []) + ([f"{metric} <= {high}"] if high is not None else [])]
    return " AND ".join(tests)


OP10 = f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rn, doc_id, t, regexp_extract_all(t, '{WORD}') AS w, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
g AS (SELECT rn, i, w[i:i+2] AS g FROM (SELECT rn, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
again AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, g) AS c FROM g) WHERE c > 1),
covered AS (SELECT rn, count(DISTINCT p) AS c FROM (SELECT rn, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY rn),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(c, 0) AS n_repeat_words, length(t) - length(replace(t, '!', '')) AS n_shouts,
    len(list_filter(w, lambda x: lower(x) IN ({", ".join(f"'{s}'" for s in STOP_WORDS)}))) AS n_stop, len(l) AS n_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^[\\x20\\t]*[-*•]'))) AS n_bullets, len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\t\\r]*$'))) AS n_ellipses
  FROM w LEFT JOIN covered USING (rn)),
r AS (
  SELECT *, CAST(word_chars AS DOUBLE) / greatest(n_words, 1) AS mean_word_chars, CAST(n_symbols AS DOUBLE) / greatest(n_words, 1) AS symbol_ratio, CAST(n_shouts AS DOUBLE) / greatest(n_words, 1) AS shout_ratio,
    CAST(n_stop AS DOUBLE) / greatest(n_words, 1) AS stop_ratio, CAST(n_dup_lines AS DOUBLE) / greatest(n_lines, 1) AS dup_line_ratio, CAST(n_bullets AS DOUBLE) / greatest(n_lines, 1) AS bullet_line_ratio,
    CAST(n_ellipses AS DOUBLE) / greatest(n_lines, 1) AS ellipsis_line_ratio, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ({_bounds()}) AS kept FROM r
"""

# CRC-32 of the UTF-8 bytes of column g of a table: the byte table once, then one step a byte.
_TABLE = "SELECT list(c ORDER BY v) AS tab FROM (SELECT v, list_reduce([v, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM (SELECT unnest(range(0, 256)) AS v))"


def _crc(text: str) -> str:
    code = f"list_transform(range(0, octet_length(encode({text}))), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {code}), lambda c, b: xor(c // 256, tab[CAST(xor(c % 256, b) AS INT) + 1])), 4294967295)"


def _features(table: str) -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"SELECT row_number() OVER () AS rn, *, regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}"


_RUNS = "list_concat(w, CASE WHEN len(w) < 2 THEN [] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1]) END)"

OP11 = f"""
WITH d AS MATERIALIZED ({_features("documents")}), f AS MATERIALIZED (SELECT rn, unnest({_RUNS}) AS g FROM d),
bf AS MATERIALIZED (SELECT unnest({_RUNS}) AS g FROM ({_features("benchmark")})),
crc AS ({_TABLE}),
b AS MATERIALIZED (SELECT g, {_crc("g")} % 10000 AS bucket FROM (SELECT g FROM f UNION SELECT g FROM bf), crc),
s AS (SELECT bucket, count(*) AS s FROM f JOIN b USING (g) GROUP BY bucket), t AS (SELECT bucket, count(*) AS t FROM bf JOIN b USING (g) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0)::DOUBLE * ((SELECT count(*) FROM f) + 10000)::DOUBLE / ((s + 1.0)::DOUBLE * ((SELECT count(*) FROM bf) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)),
m AS (SELECT rn, count(*) AS n_features, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight FROM f JOIN b USING (g) JOIN gains USING (bucket) GROUP BY rn),
x AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5)::DOUBLE / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN m USING (rn)),
r AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS n FROM x)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM r
"""

OP12 = f"""
WITH crc AS ({_TABLE}),
d AS MATERIALIZED (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w, {_crc("CAST(doc_id AS VARCHAR)")} AS h FROM documents, crc),
p AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
q AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM p),
x AS MATERIALIZED (SELECT rn, n, i, w[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1] AS v FROM (SELECT *, unnest(range(0, n)) AS i FROM q)),
-- Places whose word comes again q words later, in stretches of neighbouring places.
e AS (SELECT x.rn, x.i, y.i - x.i AS q FROM x JOIN x y ON y.rn = x.rn AND y.v = x.v AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
g AS (SELECT rn, q, i, i - row_number() OVER (PARTITION BY rn, q ORDER BY i) AS k FROM e),
l AS (SELECT rn, min(i) AS s, count(*) + q AS n, q FROM g GROUP BY rn, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
-- A stretch with several periods is a run of the smallest.
r AS MATERIALIZED (SELECT rn, s, n, min(q) AS q FROM l GROUP BY rn, s, n),
t AS (SELECT rn, count(*) AS c, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS listed FROM r GROUP BY rn),
top AS (SELECT *, row_number() OVER (PARTITION BY rn ORDER BY n::DOUBLE / q DESC, s, q) AS k FROM r),
gone AS (SELECT DISTINCT rn, unnest(range(s + q, s + n)) AS i FROM r),
kept AS (SELECT rn, string_agg(v, ' ' ORDER BY i) AS t FROM (SELECT x.* FROM x ANTI JOIN gone USING (rn, i)) GROUP BY rn)
SELECT d.doc_id, coalesce(c, 0) AS n_runs, top.s AS start, top.n AS length, top.q AS period, 1000 * top.n // top.q AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN t ON t.rn = d.rn LEFT JOIN top ON top.rn = d.rn AND top.k = 1 LEFT JOIN kept ON kept.rn = d.rn
"""


def _differs(rest: str) -> str:
    b1, n1, b2, n2 = "v.b::DOUBLE", "v.l::DOUBLE", f"({rest}.b::DOUBLE - v.b)", f"({rest}.l::DOUBLE - v.l)"
    gap = f"({b1} * {n2} - {b2} * {n1})"
    return f"(v.l > 0 AND {rest}.l > v.l AND {gap} <> 0 AND {gap} * {gap} * ({n1} + {n2}) >= {U.APART} * ({b1} + {b2}) * ({n1} + {n2} - {b1} - {b2}) * {n1} * {n2})"


def _level(k: int) -> str:
    """One level of the template tree: r{k} to r{k + 1}."""
    return f"""
x{k} AS MATERIALIZED (SELECT *, coalesce(segments[{k + 1}], '') AS value FROM r{k}),
v{k} AS MATERIALIZED (
  SELECT v.*, CASE WHEN {_differs("a")} THEN sign(v.b * a.l - a.b * v.l) ELSE 0 END AS side
  FROM (SELECT host, template, value, sum(l) AS l, sum(b) AS b FROM x{k} GROUP BY ALL HAVING sum(n) >= {U.SUPPORT} AND value <> '') v JOIN (SELECT host, template, sum(l) AS l, sum(b) AS b FROM x{k} GROUP BY ALL) a USING (host, template)),
k{k} AS (
  SELECT v.host, v.template, v.value, CASE WHEN side = 0 THEN '{U.MERGED}' WHEN s.l > v.l AND NOT {_differs("s")} THEN CASE WHEN side < 0 THEN '{U.BETTER}' ELSE '{U.WORSE}' END ELSE v.value END AS branch
  FROM v{k} v LEFT JOIN (SELECT host, template, side, sum(l) AS l, sum(b) AS b FROM v{k} GROUP BY ALL) s USING (host, template, side)),
r{k + 1} AS MATERIALIZED (SELECT host, shape, n, l, b, segments, template || coalesce(branch, CASE WHEN value = '' THEN '' ELSE '{U.VARIABLE}' END) AS template FROM x{k} LEFT JOIN k{k} USING (host, template, value)),"""


def _rules() -> str:
    cases = "".join(f"  WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'" for h, p, _ in sorted(URL_RULES, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1])))
    return f"CASE{cases} END"


OP13 = f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
p AS MATERIALIZED (
  SELECT *, {_rules()} AS rule, TRY_CAST(nullif(regexp_extract(path, '[0-9]+'), '') AS BIGINT) AS number,
    array_to_string(list_transform(string_split(path, '/')[2:{U.DEPTH + 1}], lambda s: '/' || CASE WHEN regexp_matches(s, '^[0-9a-fA-F-]{{8,}}$') AND regexp_matches(s, '[0-9]') THEN '*' ELSE regexp_replace(s, '[0-9]+', '*', 'g') END), '')
    || CASE WHEN len(string_split(path, '/')) > {U.DEPTH + 1} THEN '{U.TAIL}' ELSE '' END AS shape
  FROM h),
k AS (SELECT doc_id, max(CAST(toxic = 1 OR quality = 0 AS INT)) AS bad FROM labels GROUP BY doc_id),
r0 AS MATERIALIZED (SELECT host, shape, count(*) AS n, count(bad) AS l, count(*) FILTER (bad = 1) AS b, list_transform(string_split(shape, '/')[2:], lambda s: '/' || s) AS segments, '' AS template FROM p LEFT JOIN k ON doc_id = number GROUP BY host, shape),
{"".join(_level(k) for k in range(U.DEPTH + 1))}
leaf AS MATERIALIZED (SELECT host, template, sum(l) AS l, sum(b) AS b FROM r{U.DEPTH + 1} GROUP BY host, template),
above AS MATERIALIZED (SELECT *, CASE WHEN level = 0 THEN '' ELSE '/' || array_to_string(pieces[1:level], '/') END AS node FROM (SELECT *, unnest(range(0, len(pieces) + 1)) AS level FROM (SELECT *, string_split(template, '/')[2:] AS pieces FROM leaf))),
node AS (SELECT host, level, node, sum(l) AS l, sum(b) AS b FROM above GROUP BY ALL),
way AS (SELECT a.host, a.template, list([n.b::DOUBLE, n.l::DOUBLE] ORDER BY a.level) AS way FROM above a JOIN node n USING (host, level, node) GROUP BY ALL),
share AS (SELECT host, template, list_reduce(list_concat([[coalesce((SELECT sum(b)::DOUBLE / nullif(sum(l), 0) FROM leaf), 0), 0.0]], way), lambda up, x: [(x[1] + {U.PRIOR} * up[1]) / (x[2] + {U.PRIOR}), 0.0])[1] AS share FROM way),
bad AS (SELECT host, shape FROM r{U.DEPTH + 1} JOIN share USING (host, template) WHERE share > {U.MOST_BAD})
SELECT page_id, p.host, path, rule, CASE WHEN rule IN ({", ".join(f"'{h}{p}'" for h, p, v in URL_RULES if v == "block")}) THEN 'block' WHEN rule IS NULL AND bad.shape IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN bad ON bad.host = p.host AND bad.shape = p.shape
"""
