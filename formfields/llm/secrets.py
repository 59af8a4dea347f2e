"""Secret scans by linking the parts of multipart credentials. DataFrame expressions only.

Strong parts (assignments, access identifiers, long hex runs) are reported always. Weak parts
(bare mixed-class runs that look like secret keys, and endpoints) are reported only when complementary
parts lie in the same scope: an interval join of parts within a text, by scope cell. Every weak part needs an access
identifier, so texts without one never meet the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# The base patterns, in the order in which kinds are listed.
ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
# A run of these characters that is too short fails as a whole, so the least lengths can stand in the patterns.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
# Weak parts: a bare base-64 run as long as a provider's secret key, and a service address.
KEY = "[A-Za-z0-9+/]{40,}"
ENDPOINT = "https?://[A-Za-z0-9.-]+(?::[0-9]+)?"
KINDS = ("assign", "access", "hex", "key", "endpoint")
# Words that an assignment must contain; a cheap test before the pattern.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def let(name: str, value: str, body: str) -> str:
    """SQL: body with `name` bound to a value that is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


# Entries of an array that one step of a running fold looks at: few, so that a step is cheap, and so few blocks of them.
FOLD = 64


def before_each(values: str, step: str, nothing: str) -> str:
    """SQL: for each entry of an array (the name of a column or of a bound value) the fold of those before it; step folds {a} and {b}.

    Two levels of blocks, so that n entries cost some n * FOLD / 2 steps and nothing is copied that grows with n.
    """
    fold = lambda array: f"aggregate({array}, {nothing}, (s, x) -> {step.format(a='s', b='x')})"
    blocks = f"transform(sequence(0, size({values}) div {FOLD}), b -> {fold(f'slice({values}, b * {FOLD} + 1, {FOLD})')})"
    heads = f"transform(blocks, (v, b) -> {fold('slice(blocks, 1, b)')})"
    both = step.format(a=f"get(heads, i div {FOLD})", b=fold(f"slice({values}, (i div {FOLD}) * {FOLD} + 1, i % {FOLD})"))
    return let("blocks", blocks, let("heads", heads, f"transform({values}, (v, i) -> {both})"))


def spans_of(text: str, kind: str, pattern: str, measure: str) -> str:
    """SQL: array of structs (s, e, k) of the leftmost non-overlapping matches whose measure passes.

    Offsets come from the lengths of the gaps between matches and of the matches themselves.
    """
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    parts = f"struct(transform(split({text}, '{quoted}', -1), g -> char_length(g)) AS g, regexp_extract_all({text}, '{quoted}', 0) AS m)"
    sizes = "transform(p.m, (m, i) -> get(p.g, i) + char_length(m))"
    places = "transform(p.m, (m, i) -> struct(get(begin, i) + get(p.g, i) AS s, get(begin, i) + get(sizes, i) AS e, m AS m))"
    passed = f"transform(filter({places}, x -> {measure}), x -> struct(x.s AS s, x.e AS e, {KINDS.index(kind)} AS k))"
    return let("p", parts, let("sizes", sizes, let("begin", before_each("sizes", "{a} + {b}", "0"), passed)))


def group_length(pattern: str) -> str:
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    return f"char_length(regexp_extract(x.m, '^{quoted}', 2)) >= 6"


SALTS = 16
# Code points of the blocks into which a text is cut to be masked.
BLOCK = 2048
NOTHING = "CAST(array() AS array<struct<s:int,e:int,k:int>>)"


def spans_within(rows: DataFrame, text: str = "t") -> DataFrame:
    """rows with the arrays `strong` and `weak` of the parts of each text."""
    words = " OR ".join(f"contains(low, '{w}')" for w in ASSIGN_WORDS)
    own = [f"`{c}`" for c in rows.columns]
    cheap = rows.selectExpr(*own, f"lower({text}) AS low")
    # A row without the cheap signs never meets a pattern that has to walk through it span by span.
    signs = cheap.selectExpr(*own, f"({words}) AS has_assign", f"contains({text}, 'AKIA') AS has_access", f"rlike({text}, '[0-9a-f]{{24}}') AS has_hex", f"contains({text}, '://') AS has_url", f"rlike({text}, '[A-Za-z0-9+/]{{40}}') AS has_key")
    strong = (
        f"concat(IF(has_assign, {spans_of(text, 'assign', ASSIGN, group_length(ASSIGN))}, {NOTHING}), "
        f"IF(has_access, {spans_of(text, 'access', ACCESS, 'true')}, {NOTHING}), "
        f"IF(has_hex, {spans_of(text, 'hex', HEX, 'true')}, {NOTHING}))"
    )
    mixed = "rlike(x.m, '[A-Z]') AND rlike(x.m, '[a-z]') AND rlike(x.m, '[0-9]')"
    weak = (
        f"concat(IF(has_key, {spans_of(text, 'key', KEY, mixed)}, {NOTHING}), "
        f"IF(has_url, {spans_of(text, 'endpoint', ENDPOINT, 'true')}, {NOTHING}))"
    )
    return signs.selectExpr(*own, f"{strong} AS strong", f"{weak} AS weak")


def linked(found: DataFrame, scope: int) -> DataFrame:
    """Weak parts with complementary parts within `scope` code points in the same text: text_key, s, e, k.

    found has one row for each text. A key needs an access identifier; an endpoint needs an access identifier and a
    secret (assignment, hex or linked shape of key). The interval join is an equi-join on text and scope cell: a part
    lies in every cell that it touches, its partner looks into every cell that it touches when widened by `scope` on
    both sides.
    """
    weak = found.select("text_key", F.explode("weak").alias("w"))
    weak = weak.selectExpr("text_key", "w.s AS s", "w.e AS e", "w.k AS k", f"explode(sequence(floor((w.s - {scope}) / {scope}), floor((w.e + {scope}) / {scope}))) AS cell")
    # Complementary parts: all strong ones, and keys for endpoints.
    other = found.select("text_key", F.explode(F.concat("strong", F.expr("filter(weak, w -> w.k = 3)"))).alias("p"))
    other = other.selectExpr("text_key", "p.s AS ps", "p.e AS pe", "p.k AS pk", f"explode(sequence(floor(p.s / {scope}), floor(p.e / {scope}))) AS cell")
    near = weak.join(other, ["text_key", "cell"]).where(f"ps - e <= {scope} AND s - pe <= {scope} AND NOT (ps = s AND pe = e)")
    cases = near.groupBy("text_key", "s", "e", "k").agg(F.max((F.col("pk") == 1).cast("int")).alias("access"), F.max(F.col("pk").isin(0, 2, 3).cast("int")).alias("secret"))
    return cases.where("access = 1 AND (k = 3 OR secret = 1)").select("text_key", "s", "e", "k")


def all_spans(docs: DataFrame, scope: int, text_col: str) -> DataFrame:
    """row (the columns of docs), strong and mine (linked weak parts) of every row of docs.

    Rows without the mark of an access identifier take their spans from their own projection. The others are joined with
    the linked parts of their text: texts that repeat are looked at once, and their rows are salted.
    """
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    plain = spans_within(held.where("NOT contains(t, 'AKIA')")).selectExpr("row", "strong", f"{NOTHING} AS mine")
    marked = held.where("contains(t, 'AKIA')").withColumn("text_key", F.md5("t"))
    texts = spans_within(marked.select("text_key", "t").where("contains(t, '://') OR rlike(t, '[A-Za-z0-9+/]{40}')")).drop("t").where("size(strong) > 0 AND size(weak) > 0")
    once = written(texts.groupBy("text_key").agg(F.first("strong").alias("strong"), F.first("weak").alias("weak")), "secret-parts")
    extra = linked(once, scope).groupBy("text_key").agg(F.collect_set(F.struct("s", "e", "k")).alias("mine"))
    salted = extra.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = spans_within(marked).drop("t", "weak").withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    joined = found.join(salted, ["text_key", "salt"], "left").selectExpr("row", "strong", f"coalesce(mine, {NOTHING}) AS mine")
    return plain.unionByName(joined)


def joined(spans: str) -> Column:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform(array_sort(transform({spans}, x -> struct(x.s AS s, x.k AS k, x.e AS e))), x -> concat(element_at({names}, x.k + 1), ':', x.s, ':', x.e)), ',')")


def scan_secrets(docs: DataFrame, scope: int = 300, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_assign, n_access, n_hex, base_sha256, spans and n_weak of every row.

    Offsets are code points, ends exclusive. A row's spans depend on its own text alone: null or empty texts have none,
    rows that repeat each give a row, and so do rows with a null id or an id that other texts have too. Texts are taken
    whole, however long. An empty table gives no rows. Other columns are ignored, whatever their names. `spans` lists base
    spans and linked weak spans by start, then kind; parts that tie in both are listed by end.
    """
    found = all_spans(docs.select(F.col(id_col).alias("rid"), F.col(text_col).alias("own_text")), scope, "own_text")
    count = lambda k: F.expr(f"CAST(size(filter(strong, x -> x.k = {k})) AS long)")
    return found.select(
        F.col("row.rid").alias(id_col), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined("strong"), 256).alias("base_sha256"), joined("concat(strong, mine)").alias("spans"), F.expr("CAST(size(mine) AS long)").alias("n_weak"),
    )


def redact(docs: DataFrame, scope: int = 300, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The rows with every span of scan_secrets replaced by `mask`, columns as they were.

    Each row is masked by its own spans, whatever its id. Overlapping spans are masked as one. Rows without spans pass
    unchanged (also null texts).
    """
    found = all_spans(docs, scope, text_col)
    # Spans that begin before the end of an earlier one lie under the same mask.
    spans = "array_sort(transform(concat(strong, mine), x -> struct(x.s AS s, x.e AS e)))"
    masks = "filter(transform(spans, (x, i) -> struct(x.s AS s, get(reach, i) AS before)), x -> x.s >= x.before)"
    covered = let("ends", "transform(spans, x -> x.e)", let("reach", before_each("ends", "greatest({a}, {b})", "0"), let("masks", masks, "struct(masks AS masks, array_max(ends) AS last)")))
    # Texts are cut into blocks once, since a place far into a text is found by walking there.
    blocks = f"regexp_extract_all(row.`{text_col}`, '(?s).{{1,{BLOCK}}}', 0)"
    first, last = f"get(blocks, p.a div {BLOCK})", f"get(blocks, p.b div {BLOCK})"
    whole = f"array_join(slice(blocks, p.a div {BLOCK} + 2, greatest(0, p.b div {BLOCK} - p.a div {BLOCK} - 1)), '')"
    piece = f"IF(p.a div {BLOCK} = p.b div {BLOCK}, coalesce(substring({first}, p.a % {BLOCK} + 1, p.b - p.a), ''), concat(substring({first}, p.a % {BLOCK} + 1), {whole}, coalesce(substring({last}, 1, p.b % {BLOCK}), '')))"
    between = f"concat(transform(c.masks, x -> struct(x.before AS a, x.s AS b)), array(struct(c.last AS a, char_length(row.`{text_col}`) AS b)))"
    cut = let("spans", spans, let("c", covered, let("blocks", blocks, f"array_join(transform({between}, p -> {piece}), '{mask}')")))
    new = F.expr(f"IF(size(strong) + size(mine) = 0, row.`{text_col}`, {cut})")
    return found.select(*[(new if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])
