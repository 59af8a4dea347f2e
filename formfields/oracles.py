"""DuckDB SQL of the form queries that were added after the first ones; each is written from the rule, not from the plan."""

from __future__ import annotations

from .operators.anchors import LABEL_KEYWORDS
from .operators.layout import NEEDED, SECTIONS, SHOWN
from .functions.text import DISPLAY_WORDS
from .operators.second_pass import ENGINE_LABELS
from .plans.rules import FIELD_ORDER
from .sources.forms import MARKUP


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def shown(column: str) -> str:
    for plain, restored in DISPLAY_WORDS.items():
        column = f"regexp_replace({column}, '\\b{plain}\\b', '{restored}', 'g')"
    return column


def later_sql(truth: str, words: str, assembled: str, chain: str, extents: str, rules: str, field_rules: str, rois: str, windows: str, folded, norm) -> dict[str, str]:
    ends = "SELECT page_id, line_num, x, word_no, x + w / 2.0 AS cx, y + CAST(floor(x * (page_id % 7 - 3) / 50.0) AS INT) + h / 2.0 AS cy, row_number() OVER (PARTITION BY page_id, line_num ORDER BY x, word_no) AS f, row_number() OVER (PARTITION BY page_id, line_num ORDER BY x DESC, word_no DESC) AS l, count(*) OVER (PARTITION BY page_id, line_num) AS n FROM words"
    skew = f"""WITH {words}, e AS ({ends}), s AS (SELECT a.page_id, CASE WHEN a.n > 1 THEN degrees(atan2(b.cy - a.cy, b.cx - a.cx)) END AS angle FROM e a JOIN e b ON a.page_id = b.page_id AND a.line_num = b.line_num AND a.f = 1 AND b.l = 1)
SELECT page_id, round(coalesce(quantile_cont(angle, 0.5) FILTER (abs(angle) <= 30), 0.0), 6) AS skew_angle_deg FROM s GROUP BY page_id"""
    date_parts = "string_split_regex(m, '\\s*[./-]\\s*')"
    regex = f"""WITH {chain}, {assembled}, {field_rules},
text AS (SELECT page_id, string_agg({folded('text')}, chr(10) ORDER BY y, x, line_num) AS t FROM joined GROUP BY page_id),
found_dates AS (SELECT page_id, i, lpad(p[1], 2, '0') || '/' || lpad(p[2], 2, '0') || '/' || CASE WHEN length(p[3]) = 2 THEN '20' || p[3] ELSE p[3] END AS d FROM (SELECT page_id, i, {date_parts} AS p FROM (
  SELECT page_id, unnest(ms) AS m, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(t, '\\b[0-9]{{1,2}}\\s*[./-]\\s*[0-9]{{1,2}}\\s*[./-]\\s*[0-9]{{2,4}}\\b') AS ms FROM text)))),
dates AS (SELECT page_id, d, row_number() OVER (PARTITION BY page_id ORDER BY min(i)) AS k FROM found_dates WHERE length(d) = 10 AND CAST(substr(d, 1, 2) AS INT) BETWEEN 1 AND 31 AND CAST(substr(d, 4, 2) AS INT) BETWEEN 1 AND 12 AND CAST(substr(d, 7, 4) AS INT) BETWEEN 1950 AND 2035 GROUP BY page_id, d),
cells AS (
  SELECT page_id, 'plate' AS field, 'page_regex_plate' AS method, nullif(regexp_extract(t, '\\b[0-9]{{2}}\\s?[A-Z]{{1,3}}\\s?[0-9]{{2,4}}\\b'), '') AS raw FROM text
  UNION ALL SELECT page_id, 'chassis_no', 'page_regex_vin', list_filter(regexp_extract_all(t, '\\b[A-HJ-NPR-Z0-9]{{17}}\\b'), lambda v: regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[0-9]'))[1] FROM text
  UNION ALL SELECT page_id, CASE k WHEN 1 THEN 'first_registration_date' WHEN 2 THEN 'registration_date' ELSE 'inspection_date' END, 'page_regex_date_sequence', d FROM dates WHERE k <= 3
  UNION ALL SELECT page_id, 'model_year', 'page_regex_model_year', list_min(regexp_extract_all(t, '\\b(19[5-9][0-9]|20[0-3][0-9])\\b')) FROM text
  UNION ALL SELECT page_id, 'tax_or_id_no', 'page_regex_tax_or_id', regexp_extract_all(t, '\\b[0-9]{{10,11}}\\b')[1] FROM text)
SELECT c.page_id, c.field, c.method, c.raw FROM cells c JOIN field_rules r USING (field) WHERE raw IS NOT NULL AND NOT EXISTS (SELECT 1 FROM anchors a WHERE a.page_id = c.page_id AND a.page_id % 3 > 0 AND a.anchor = r.anchor)"""
    region = f"WITH {chain}, {field_rules}, rois AS ({rois}) SELECT r.page_id, r.field, string_agg(w.text, ' ' ORDER BY w.y, w.x, w.word_no) AS text FROM rois r JOIN words w ON w.page_id = r.page_id AND w.x >= rx AND w.y >= ry AND w.x + w.w <= rx + rw AND w.y + w.h <= ry + rh GROUP BY r.page_id, r.field"
    upper_count = lambda chars: f"length(regexp_replace(upper(text), '[^{chars}]', '', 'g'))"
    tokens = "regexp_extract_all(upper(text), '[A-Z0-9]+')"
    quality = (
        f"(coalesce(list_max(list_transform({tokens}, lambda t: length(t))), 0) + CASE WHEN len(list_filter({tokens}, lambda t: regexp_matches(t, '[A-Z]') AND regexp_matches(t, '[0-9]'))) > 0 THEN 5 ELSE 0 END"
        f" + least({upper_count('A-Z')}, 8) // 3 + least({upper_count('0-9')}, 8) // 3)"
    )
    lines_of = lambda regions, keys: f"""SELECT r.page_id, r.field, {keys}, w.line_num, string_agg(w.text, ' ' ORDER BY w.x, w.word_no) AS text, min(w.x) AS x, min(w.y) AS y, max(w.x + w.w) - min(w.x) AS w, max(w.y + w.h) - min(w.y) AS h, avg(w.conf) AS avg_conf
  FROM {regions} r JOIN words w ON w.page_id = r.page_id AND w.x + w.w / 2.0 BETWEEN rx AND rx + rw AND w.y + w.h / 2.0 BETWEEN ry AND ry + rh GROUP BY r.page_id, r.field, {keys}, w.line_num"""  # noqa: E731
    best = f"""{chain}, {field_rules}, win AS ({windows}), boxes AS (SELECT win.*, direction, ax, ay, aw, ah FROM win JOIN field_rules USING (field) JOIN anchors ON anchors.page_id = win.page_id AND anchors.anchor = field_rules.anchor),
lines_in AS ({lines_of('boxes', 'r.direction, r.ax, r.ay, r.aw, r.ah')}),
able AS (SELECT *, {quality} AS q, CASE WHEN direction = 'right' THEN x >= ax + aw - 4 ELSE y >= ay + ah - 4 END AS front FROM lines_in WHERE {upper_count('A-Z0-9')} >= 2),
pool AS (SELECT *, bool_or(front) OVER (PARTITION BY page_id, field) AS any_front FROM able),
ranked AS (SELECT *, CASE WHEN direction = 'right' THEN abs(y + h / 2.0 - ay - ah / 2.0) + 0.35::DOUBLE * greatest(0, ax + aw - x) - 2.5::DOUBLE * q ELSE abs(y - ay - ah) - 2.0::DOUBLE * q END AS s FROM pool WHERE front OR NOT any_front),
best AS (SELECT page_id, field, CASE WHEN direction = 'right' THEN 'anchor_right_line' ELSE 'anchor_below_line' END AS method, text AS raw FROM ranked QUALIFY row_number() OVER (PARTITION BY page_id, field ORDER BY s, avg_conf DESC, x, y, line_num) = 1)"""
    roi_lines = f"""WITH {chain}, {field_rules}, rois AS ({rois}), lines_in AS ({lines_of('rois', 'r.rx, r.ry, r.rw, r.rh')})
SELECT page_id, field, 'roi_line' AS method, text AS raw FROM lines_in QUALIFY row_number() OVER (PARTITION BY page_id, field ORDER BY abs(y + h / 2.0 - ry - rh / 2.0), avg_conf DESC, x, y, line_num) = 1"""
    line_quality = f"WITH {best} SELECT b.field, method, count(*) FILTER (raw = value) AS tp, count(*) FILTER (raw IS DISTINCT FROM value) AS fp, CAST(0 AS BIGINT) AS fn FROM best b LEFT JOIN ({truth}) t ON t.page_id = b.page_id AND t.field = b.field GROUP BY b.field, method"
    year = "'^(?:19|20)[0-9]{2}$'"
    rescued = "SELECT p.page_id, value, CASE WHEN value IS NULL THEN 'empty_fallback' ELSE '{method}' END AS method, CASE WHEN value IS NULL THEN 0 ELSE {score} END AS confidence_score, value IS NULL AS low_confidence FROM (SELECT DISTINCT page_id FROM words) p LEFT JOIN best USING (page_id)"
    serial = f"""WITH {words}, inside AS (SELECT page_id, word_no, text FROM words WHERE (x + w / 2.0) / 1600 BETWEEN 0.52::DOUBLE AND 0.52::DOUBLE + 0.45::DOUBLE AND (y + h / 2.0) / 1000 BETWEEN 0.78::DOUBLE AND 0.78::DOUBLE + 0.2::DOUBLE),
reads AS (
  SELECT page_id, word_no, 0 AS pass, regexp_extract(text, '(?i)(?:Seri?|Sen|Sec|Sc|Se)[A-Za-z]{{0,6}}([0-9]{{4,8}})', 1) AS v FROM inside
  UNION ALL SELECT page_id, word_no, 1, regexp_extract(upper(text), '[A-Z]{{1,4}}([0-9]{{4,8}})$', 1) FROM inside
  UNION ALL SELECT page_id, word_no, 2, regexp_extract(regexp_replace(text, '[^0-9]', '', 'g'), '^[0-9]{{5,8}}$') FROM inside),
best AS (SELECT page_id, v AS value FROM reads WHERE v <> '' AND NOT regexp_matches(v, {year}) QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY pass, word_no) = 1)
{rescued.format(method='page_serial_rescue', score=60)}"""
    labels = ", ".join(map(quoted, ENGINE_LABELS))
    engine = f"""WITH {words}, codes AS (SELECT page_id, word_no, (x + w / 2.0) / 1600 AS cx, (y + h / 2.0) / 1000 AS cy, regexp_replace(upper(text), '[^A-Z0-9]', '', 'g') AS c FROM words),
able AS (SELECT * FROM codes WHERE cx <= 0.52::DOUBLE AND cy >= 0.35::DOUBLE AND cy <= 0.85::DOUBLE AND length(c) BETWEEN 5 AND 15 AND regexp_matches(c, '^(?:[A-Z]{{1,3}}[0-9]{{5,12}}|K9K[A-Z0-9]{{5,9}})$') AND NOT regexp_matches(c, '^[A-Z]{{1,2}}[0-9][A-Z]{{3,}}') AND c NOT IN ({labels})),
best AS (SELECT page_id, c AS value FROM able QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY cy < 0.45::DOUBLE, CASE WHEN c LIKE 'K9K%' THEN 0 WHEN regexp_matches(c, '^[A-Z]{{2}}[0-9]{{5,7}}$') THEN 1 WHEN regexp_matches(c, '^[A-Z]{{3}}[0-9]{{5,9}}$') THEN 2 ELSE 3 END, cy, word_no) = 1)
{rescued.format(method='v31_engine_page_rescue', score=55)}"""
    vin = f"""WITH m AS (SELECT page_id, 'VE' || CASE WHEN page_id % 2 = 0 THEN 'I' ELSE '1' END || substr(value, 4, 1) || CASE WHEN page_id % 3 = 0 THEN '8N5T' ELSE '5A8' END || substr(value, 5, 10) AS code FROM ({truth}) WHERE field = 'chassis_no')
SELECT page_id, list_reduce(list_concat([''], string_split(code, '')), lambda a, c: a || CASE WHEN c = '8' AND regexp_matches(a, '[A-Z]$') THEN 'B' WHEN c = '5' AND regexp_matches(a, '[A-Z]$') AND regexp_matches(substr(code, length(a) + 2, 1), '[A-Z]') THEN 'S'
  WHEN c = 'E' AND a = 'V' THEN 'F' WHEN c = 'I' AND a IN ('VF', 'VE') THEN '1' ELSE c END) AS value FROM m"""
    valid = f"""WITH v AS (SELECT page_id, field, CASE page_id % 4 WHEN 0 THEN 'NO ' || value WHEN 1 THEN substr(value, 1, 6) ELSE value END AS v FROM ({truth}) WHERE field IN ('model_year', 'tax_or_id_no', 'serial_no', 'inspection_date', 'engine_no')),
d AS (SELECT *, regexp_replace(v, '[^0-9]', '', 'g') AS digits, regexp_extract(v, '([0-9]{{1,2}})[/.-]([0-9]{{1,2}})[/.-]([0-9]{{2,4}})', ['a', 'b', 'c']) AS p FROM v),
n AS (SELECT *, TRY_CAST(CASE WHEN length(p.c) = 2 THEN '20' || p.c ELSE p.c END AS INT) AS y FROM d),
f AS (SELECT page_id, field, v, CASE field
  WHEN 'model_year' THEN nullif(regexp_extract(v, '\\b(19[5-9][0-9]|20[0-3][0-9])\\b'), '') WHEN 'tax_or_id_no' THEN CASE WHEN length(digits) IN (10, 11) THEN digits ELSE nullif(regexp_extract(v, '[0-9]{{10,11}}'), '') END
  WHEN 'serial_no' THEN regexp_extract_all(v, '[0-9]{{4,7}}')[-1] WHEN 'engine_no' THEN substr(upper(trim(v)), 1, 3) || translate(substr(upper(trim(v)), 4), 'OI', '01')
  ELSE CASE WHEN TRY_CAST(p.a AS INT) BETWEEN 1 AND 31 AND TRY_CAST(p.b AS INT) BETWEEN 1 AND 12 AND y BETWEEN 1900 AND 2100 THEN lpad(p.a, 2, '0') || '/' || lpad(p.b, 2, '0') || '/' || y END END AS fixed FROM n)
SELECT page_id, field, fixed AS value, CASE WHEN fixed IS NULL THEN 'postprocess_validation_failed' ELSE 'roi_line' END AS method, fixed IS NULL AS low_confidence, CASE WHEN fixed IS NULL THEN 'postprocess_validation_failed' END AS abstain_reason, coalesce(fixed <> v, false) AS postprocess_applied FROM f"""
    keys = ", ".join(f"({quoted(a)}, {quoted(k)})" for a, ks in LABEL_KEYWORDS.items() for k in ks)
    scaled = "CAST(trunc({c} * {image} / CAST({whole} AS DOUBLE)) AS INT)"
    at = lambda c, image, whole: scaled.format(c=c, image=image, whole=whole)
    exemplars = f"""{words}, {extents}, keys AS (SELECT * FROM (VALUES {keys}) t(anchor, key)),
named AS (SELECT DISTINCT anchor, page_id, word_no, {at('x', 3200, 'ext_w')} AS sx, {at('y', 2000, 'ext_h')} AS sy, {at('w', 3200, 'ext_w')} AS sw, {at('h', 2000, 'ext_h')} AS sh FROM words JOIN ext USING (page_id) JOIN keys ON contains(upper(trim(text)), key) WHERE conf >= 65),
shown AS (SELECT anchor, page_id, word_no, greatest(0, sx - 4) AS x1, greatest(0, sy - 4) AS y1, least(3200, sx + sw + 4) AS x2, least(2000, sy + sh + 4) AS y2 FROM named WHERE sw >= 5 AND sh >= 5),
exemplars AS (SELECT * FROM shown QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY page_id, word_no) <= 5)"""
    report = f"WITH {exemplars}, {rules}, n AS (SELECT r.anchor, count(e.anchor) AS n FROM rules r LEFT JOIN (SELECT * FROM exemplars WHERE page_id % 3 > 0) e ON e.anchor = r.anchor GROUP BY r.anchor) SELECT anchor, n, CASE WHEN n >= 3 THEN 'enough' WHEN n > 0 THEN 'some' ELSE 'none' END AS grade FROM n"
    payload = f"""WITH {words}, placed AS (SELECT *, dense_rank() OVER (PARTITION BY page_id ORDER BY line_num % 2, line_num) AS ln FROM words)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY ln, x) - 1 AS word_no, text, round(conf, 6) AS conf, x, y, w, h, CAST(ln AS INT) AS line_num FROM placed"""
    grab = lambda a, b: f"trim(regexp_replace(regexp_extract(n, '(?is){a}\\s*(.*?)\\s*{b}', 1), '\\s+', ' ', 'g'))"
    cells = ", ".join(f"{grab(a, b)} AS {name}" for name, (a, b) in SECTIONS.items())
    final = {"serial_no": "trim(regexp_replace(serial_no, 'N°|NO', '', 'g'))", "approver": "regexp_replace(approver, '\\s+(S\\.N\\.Y\\.[0-9]+)\\s*$', ' (\\1)')"}
    value = lambda name: shown(final.get(name, name)) if name in SHOWN else final.get(name, name)
    wide = ", ".join(f"max(CASE WHEN field = '{f}' THEN value END) AS {f}" for f in FIELD_ORDER)
    flat = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(html, chr(13), chr(10)), '<img[^>]*>', ' ', 'gi'), '</(?:tr|table|td)>|<br\\s*/?>', chr(10), 'gi'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"
    sections = f"""WITH t AS (SELECT page_id, {wide} FROM ({truth}) GROUP BY page_id), h AS (SELECT page_id, {MARKUP} AS html FROM t), f AS (SELECT page_id, replace({folded(flat)}, 'N°', 'NO') AS n FROM h), c AS (SELECT page_id, {cells} FROM f)
SELECT page_id, {", ".join(f"{value(n)} AS {n}" for n in SECTIONS)} FROM c WHERE {" AND ".join(f"{n} <> ''" for n in NEEDED)}"""
    documents = f"SELECT 'page-' || page_id AS image, {', '.join(f'''coalesce(max(CASE WHEN field = '{f}' THEN value END), '') AS {f}''' for f in FIELD_ORDER)} FROM ({truth}) GROUP BY page_id"
    raw = "CASE WHEN page_id % 2 = 0 THEN replace(value, '/', '.') ELSE 'TARIH: ' || value END"
    dates = f"""WITH r AS (SELECT page_id, field, regexp_extract({raw}, '([0-9]{{1,2}})\\s*[/.-]\\s*([0-9]{{1,2}})\\s*[/.-]\\s*([0-9]{{2,4}})', ['a', 'b', 'c']) AS p FROM ({truth}) WHERE field LIKE '%date'), d AS (SELECT page_id, field, p, lpad(p.a, 2, '0') || '/' || lpad(p.b, 2, '0') || '/' || CASE WHEN length(p.c) = 2 THEN '20' || p.c ELSE p.c END AS d FROM r)
SELECT page_id, field, d AS cleaned, CASE WHEN CAST(p.a AS INT) BETWEEN 1 AND 31 AND CAST(p.b AS INT) BETWEEN 1 AND 12 AND CAST(substr(d, 7) AS INT) BETWEEN 1900 AND 2100 THEN d END AS fixed FROM d"""
    boxes = f"""WITH {best.replace("text AS raw FROM ranked", "text AS raw, x, y, w, h FROM ranked")}, rois AS ({rois}),
in_rois AS ({lines_of('rois', 'r.rx, r.ry, r.rw, r.rh')}),
middle AS (SELECT page_id, field, 'roi_line' AS method, text AS raw, x, y, w, h FROM in_rois QUALIFY row_number() OVER (PARTITION BY page_id, field ORDER BY abs(y + h / 2.0 - ry - rh / 2.0), avg_conf DESC, x, y, line_num) = 1)
SELECT b.*, rx AS roi_x, ry AS roi_y, rw AS roi_w, rh AS roi_h FROM (SELECT * FROM best UNION ALL SELECT * FROM middle) b LEFT JOIN rois USING (page_id, field)"""
    digit_fields = f"SELECT page_id, field, value AS v, CASE field WHEN 'model_year' THEN 4 ELSE 9 END AS threshold FROM ({truth}) WHERE field IN ('model_year', 'tax_or_id_no')"
    # A third of the pages has its value; the others have none, or two digits, which is below both thresholds.
    gate = f"SELECT page_id, field FROM ({digit_fields}) WHERE page_id % 3 < 2"
    crop = f"""SELECT page_id, field, v AS value, CASE WHEN page_id % 3 = 2 THEN v WHEN page_id % 2 = 0 THEN 'NO 1 ' || v ELSE v || ' X9' END AS raw,
  CASE WHEN page_id % 3 = 2 THEN 'roi_line' WHEN page_id % 2 = 0 THEN 'roi_tesseract_preprocessed' ELSE 'roi_tesseract_raw' END AS method, length(v) AS confidence_score, false AS low_confidence FROM ({digit_fields})"""
    second = f"""SELECT page_id, field, CASE WHEN asked AND page_id % 4 < 2 THEN NULL WHEN asked AND page_id % 4 = 2 OR page_id % 3 > 0 THEN v END AS value, CASE WHEN asked AND page_id % 4 < 2 THEN '' ELSE v END AS raw,
  CASE WHEN asked AND page_id % 4 < 3 THEN 'glm_roi_fallback' ELSE 'roi_line' END AS method, CASE WHEN asked AND page_id % 4 < 2 THEN 100 WHEN asked AND page_id % 4 = 2 OR page_id % 3 > 0 THEN length(v) ELSE 0 END AS confidence_score,
  CASE WHEN asked AND page_id % 4 < 2 THEN false WHEN asked AND page_id % 4 = 2 THEN length(v) < 4 ELSE page_id % 3 < 2 END AS low_confidence, asked AND page_id % 4 < 3 AS secondary_applied
FROM (SELECT page_id, field, value AS v, page_id % 3 < 2 AS asked FROM ({truth}) WHERE field = 'owner_name')"""
    template = f"""WITH {chain} SELECT * FROM anchors WHERE anchor = 'serial_label'
UNION ALL SELECT page_id, 'serial_label', '[template:a.png]', 0.605::DOUBLE + page_id % 7 / 100::DOUBLE, 903, 830, 150, 24 FROM (SELECT DISTINCT page_id FROM words) p WHERE page_id % 5 = 4 AND page_id % 7 >= 2 AND NOT EXISTS (SELECT 1 FROM anchors a WHERE a.page_id = p.page_id AND a.anchor = 'serial_label')"""
    nested = r"""WITH p AS (
  SELECT conv_id, turn, unnest([0, 1, 2, 3]) AS k, unnest([trim(regexp_replace(text, '\s+', ' ', 'g')), 'note ' || turn, 'see ' || turn % 3, 'note ' || (turn - 1)]) AS part FROM conversations
  UNION ALL SELECT DISTINCT conv_id, -1, 0, 'conversation ' || conv_id FROM conversations),
f AS (SELECT conv_id, part, min([turn, k]) AS place FROM p WHERE part <> '' GROUP BY conv_id, part)
SELECT conv_id AS page_id, string_agg(part, chr(10) ORDER BY place) AS text FROM f GROUP BY conv_id"""
    return {
        "line_boxes": boxes, "crop_gate": gate, "crop_choice": crop, "secondary_choice": second, "template_anchors": template, "layout_json": nested,
        "brand_names": f"SELECT page_id, field, CASE WHEN page_id % 4 < 3 THEN value END AS value FROM ({truth}) WHERE field = 'brand'",
        "request_metrics": "SELECT event_type AS provider, count(*) AS requests, round(avg(value), 1) AS avg_latency_ms, max(value) AS max_latency_ms FROM events GROUP BY event_type",
        "best_lines_exact": f"WITH {best} SELECT page_id, field, method, raw FROM best", "roi_lines": roi_lines, "line_quality": line_quality,
        "fill_counts": f"SELECT page_id, count(*) AS n, count(*) FILTER ((page_id * 31 + length(value)) % 5 > 0) AS n_filled FROM ({truth}) GROUP BY page_id",
        "page_skew": skew, "page_regex": regex, "region_text": region, "serial_rescue": serial, "engine_rescue": engine, "vin_fix": vin, "validate_fields": valid, "exemplars": f"WITH {exemplars} SELECT anchor, page_id, word_no, x1, y1, x2, y2 FROM exemplars", "exemplar_report": report,
        "page_coverage": f"WITH {chain} SELECT page_id, (SELECT count(*) FROM anchors a WHERE a.page_id = p.page_id) AS n_found, (SELECT count(*) FROM rules) AS n_defined FROM (SELECT DISTINCT page_id FROM words) p",
        "words_csv": f"WITH {words} SELECT page_id, text, {norm('text')} AS norm_text, round(conf, 2) AS conf, x, y, w, h, round(x / 1600.0::DOUBLE, 4) AS norm_x, round(y / 1000.0::DOUBLE, 4) AS norm_y, 1 AS block, 1 AS par, line_num AS line FROM words",
        "payload_words": payload, "payload_text": f"WITH {words} SELECT page_id, string_agg(text, chr(10) ORDER BY line_no % 2, line_no) AS text FROM lines GROUP BY page_id", "labelled_sections": sections, "result_documents": documents, "clean_dates": dates,
    }
