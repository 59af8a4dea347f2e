"""DuckDB SQL of what strategies and field filters make of a line, written from their rules."""

from __future__ import annotations

from .functions.filters import ADDRESS_START, COMPANY_WORDS, GENERIC_TYPES, NO_SURNAMES, TYPE_BLOCK, TYPE_NOISE
from .functions.text import LABEL_WORDS, OWNER_LABELS, PLATE, TYPE_LABELS

MIXED = "regexp_matches(x, '[A-Z]') AND regexp_matches(x, '[0-9]')"


def among(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def tokens(column: str, pattern: str) -> str:
    return f"regexp_extract_all({column}, '{pattern}')"


def kept(items: str, test: str) -> str:
    return f"list_filter({items}, lambda x: {test})"


def joined(items: str, glue: str = " ") -> str:
    return f"array_to_string({items}, '{glue}')"


def without(column: str, words: str) -> str:
    removed = f"regexp_replace({column}, '\\b(?:{words.replace(' ', '|')})\\b', ' ', 'g')"
    return f"trim(regexp_replace({removed}, '\\s+', ' ', 'g'))"


def first_of_most(items: str, size: str) -> str:
    """The first of the items with the largest size, which must be above zero."""
    sizes = f"list_transform({items}, lambda x: {size})"
    return kept(items, f"{size} > 0 AND {size} = list_max({sizes})") + "[1]"


def plate(tk: str) -> str:
    run = joined(f"{tk}[i:i + n - 1]", "")
    runs = f"flatten(list_transform(range(1, len({tk}) + 1), lambda i: list_transform(range(1, least(4, len({tk}) - i + 1) + 1), lambda n: {run})))"
    return f"coalesce({kept(runs, f'''regexp_matches(x, '{PLATE}')''')}[1], {joined(tk, '')})"


def value_sql(words: str, assembled: str, folded) -> dict[str, str]:
    blank = lambda c: f"nullif(trim({c}), '')"
    date = "([0-9]{1,2})\\s*/\\s*([0-9]{1,2})\\s*/\\s*([0-9]{2,4})"
    pick = lambda k: f"regexp_extract(slashed, '{date}', {k})"
    year = f"CASE WHEN length({pick(3)}) = 2 THEN '20' || {pick(3)} ELSE {pick(3)} END"
    pure = "length(replace(x, '-', ''))"
    lines = f"""{words}, {assembled},
f AS (SELECT page_id, line_num, text, {folded('text')} AS t FROM joined),
c AS (SELECT *, trim(regexp_replace(regexp_replace(t, '[^A-Z0-9 ./-]+', ' ', 'g'), ' +', ' ', 'g')) AS plain, regexp_replace(t, '[.-]', '/', 'g') AS slashed, {tokens('t', '[A-Z0-9]+')} AS tk, {tokens('t', '[A-Z0-9-]+')} AS hyphened FROM f)"""
    mixed = lambda items: kept(items, MIXED)
    standard = f"""WITH {lines},
s AS (SELECT *, CASE WHEN len({mixed('hyphened')}) > 0 THEN {mixed('hyphened')} ELSE hyphened END AS pool, {kept(f"string_split({without('plain', OWNER_LABELS)}, ' ')", 'length(x) > 1')} AS parts, {tokens(without('plain', TYPE_LABELS), '[A-Z0-9.-]+')} AS types, {tokens('text', '[0-9]+')} AS numbers FROM c),
p AS (SELECT *, {first_of_most('pool', pure)} AS code FROM s)
SELECT page_id, line_num, {blank(plate('tk'))} AS plate, {first_of_most('numbers', 'length(x)')} AS digits, CASE WHEN {pick(3)} <> '' THEN lpad({pick(1)}, 2, '0') || '/' || lpad({pick(2)}, 2, '0') || '/' || {year} END AS date,
  {blank("replace(code, '-', '')")} AS alnum_upper, {blank('code')} AS alnum_hyphen_upper, {blank('plain')} AS text_upper, {blank(joined('parts[1:10]'))} AS owner_text,
  {blank(joined(f'CASE WHEN len(types) > 1 AND len({mixed("types")}) > 0 THEN {mixed("types")}[1:3] ELSE types[1:4] END'))} AS vehicle_type, {blank("regexp_replace(text, '\\s+', ' ', 'g')")} AS keep FROM p"""
    noise = f"len(tk) = 0 OR len(tk) = 1 AND length(tk[1]) <= 2 OR len({kept('tk', f'x IN {among(LABEL_WORDS)}')}) >= greatest(1, len(tk) - 1)"
    unnamed = "regexp_replace(regexp_replace(plain, '\\b(?:SOYADI|ADI)\\b', ' ', 'g'), '\\bTICARI\\s+UNVAN[I1]?\\b', 'TICARI UNVANI', 'g')"
    body = f"trim(regexp_replace(regexp_replace(string_split_regex({unnamed}, '{ADDRESS_START}')[1], '\\b[0-9]{{2,}}\\b', ' ', 'g'), '\\s+', ' ', 'g'))"
    company = f"x IN {among(COMPANY_WORDS)}"
    surname = f"CASE WHEN len({kept('names', company)}) > 0 THEN {kept('names', '''length(x) >= 2 AND x NOT IN ('NOTER', 'TESCIL', 'TARIHI')''')}[1:8] ELSE {kept('names', 'length(x) >= 3')}[1:2] END"
    types = kept(tokens("plain", "[A-Z0-9.-]+"), f"x NOT IN {among(TYPE_BLOCK + TYPE_NOISE)} AND NOT regexp_matches(x, '^[0-9]{{4}}$') AND NOT regexp_matches(x, '^D\\.?[0-9]+$')")
    part = lambda at, n: f"TRY_CAST(substr(plain, {at}, {n}) AS INT)"
    digits = "regexp_replace(plain, '[^0-9]', '', 'g')"
    filters = f"""WITH {lines},
g AS (SELECT *, {noise} AS noise, {body} AS body, {tokens('plain', '[A-Z]+')} AS given, regexp_replace(plain, '[^A-Z0-9]', '', 'g') AS code, {plate('tk')} AS found FROM c WHERE plain <> ''),
n AS (SELECT *, {tokens('body', '[A-Z]+')} AS names FROM g)
SELECT page_id, line_num, CASE WHEN regexp_matches(found, '{PLATE}') THEN found END AS plate, CASE WHEN NOT noise THEN plain END AS brand, CASE WHEN NOT noise THEN {tokens('plain', '[0-9]{4,7}')}[-1] END AS serial_no,
  CASE WHEN NOT noise AND plain NOT IN {among(NO_SURNAMES)} AND length(body) >= 3 THEN {blank(joined(surname))} END AS owner_surname,
  CASE WHEN NOT noise AND len({kept('given', company)}) = 0 THEN {blank(joined(kept('given', 'length(x) >= 2') + '[1:3]'))} END AS owner_name,
  CASE WHEN NOT noise AND plain NOT IN {among(GENERIC_TYPES)} THEN {blank(joined(types + '[1:6]'))} END AS type,
  CASE WHEN length(code) >= 8 AND code NOT IN {among(LABEL_WORDS)} THEN CASE WHEN length(code) >= 16 THEN translate(substr(code, 1, 3), 'OQ', '00') || translate(substr(code, 4), 'OQI', '001') WHEN length(code) >= 12 THEN code END END AS chassis_no,
  CASE WHEN length({digits}) IN (10, 11) THEN {digits} END AS tax_or_id_no,
  CASE WHEN regexp_matches(plain, '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}$') AND {part(1, 2)} BETWEEN 1 AND 31 AND {part(4, 2)} BETWEEN 1 AND 12 AND {part(7, 4)} BETWEEN 1950 AND 2035 THEN plain END AS inspection_date FROM n"""
    return {"standard_values": standard, "field_filters": filters}


def choice_sql(truth: str, ways: str) -> str:
    return f"""WITH r AS (
  SELECT page_id, field, value AS v, length(value) AS n, cand_no, method, priority, page_id + 3 * cand_no + length(value) AS turn, page_id % 4 * 3 AS threshold, page_id % 5 = 0 AND method = 'roi_line' AS forced FROM ({truth}) CROSS JOIN (VALUES {ways}) w(cand_no, method, priority)),
a AS (SELECT *, turn % 3 * 5 AS score FROM r WHERE turn % 4 > 0 AND (threshold = 0 OR turn % 3 * 5 >= threshold)),
b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY page_id, field ORDER BY forced DESC, score DESC, priority DESC, cand_no) = 1)
SELECT p.page_id, p.field, v || '/' || method AS value, v || ' ' || method AS raw, coalesce(method, 'empty_fallback') AS method, CAST(coalesce(score, 0) AS INT) AS confidence_score, v IS NULL AND p.threshold > 0 AS low_confidence
FROM (SELECT DISTINCT page_id, field, threshold FROM r) p LEFT JOIN b USING (page_id, field)"""


# The width left in a line is shared by the characters left; a list holds the place reached, the characters left and the starts so far.
SHARED = "greatest(1, CAST(round_even((w - a[1]) * b[1] / CAST(a[2] AS DOUBLE), 0) AS BIGINT))"
DOC_WORDS = f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, unnest(range(0, len(string_split(text, chr(10))))) AS line_no FROM documents),
p AS (SELECT doc_id, line_no, CAST(10 * length(text) AS BIGINT) AS w, {kept("string_split_regex(text, '[ \\t-\\r]+')", "x <> ''")} AS parts FROM l),
r AS (SELECT *, list_reduce(list_concat([[CAST(0 AS BIGINT), CAST(length(array_to_string(parts, '')) AS BIGINT)]], list_transform(parts, lambda x: [CAST(length(x) AS BIGINT)])), lambda a, b: list_concat([a[1] + {SHARED}, a[2] - b[1]], a[3:], [a[1] + {SHARED}])) AS done FROM p WHERE len(parts) > 0),
s AS (SELECT *, list_concat([CAST(0 AS BIGINT)], done[3:]) AS starts FROM r),
o AS (SELECT *, unnest(parts) AS word, unnest(range(1, len(parts) + 1)) AS i FROM s)
SELECT doc_id AS page_id, row_number() OVER (PARTITION BY doc_id ORDER BY 30 * line_no, starts[i], line_no, i) - 1 AS word_no, word AS text, CAST(40 + (doc_id * 7 + line_no * 13) % 61 AS DOUBLE) AS conf,
  starts[i] AS x, 30 * line_no AS y, greatest(1, CASE WHEN i < len(parts) THEN starts[i + 1] ELSE w END - starts[i]) AS w, 20 AS h, 1 AS block_num, 1 AS par_num, line_no AS line_num FROM o"""
