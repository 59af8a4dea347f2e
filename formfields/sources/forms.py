"""Form pages derived from the orders table: one page a row, with known field values and ten kinds of noise."""

from __future__ import annotations

import ast

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.words import lines_to_words

PAGE_W, PAGE_H = 1600, 1000
# Pages of a partition: some quarter of a million words.
PARTITION_PAGES = 8192

# Portable SQL (Spark and DuckDB), integer arithmetic and string functions only.
TRUTH = """
SELECT k AS page_id, l.field_no, l.field,
  CASE l.field
    WHEN 'plate' THEN lpad(CAST(k % 81 + 1 AS STRING), 2, '0') || chr(CAST(65 + k % 8 AS INT)) || chr(CAST(65 + c % 8 AS INT)) || CAST(100 + (k * 7) % 900 AS STRING)
    WHEN 'chassis_no' THEN 'VF1' || chr(CAST(65 + k % 8 AS INT)) || lpad(CAST((k * 7919 + c * 31) % 10000000000000 AS STRING), 13, '0')
    WHEN 'engine_no' THEN chr(CAST(65 + c % 8 AS INT)) || chr(CAST(65 + k % 8 AS INT)) || lpad(CAST((k * 13 + c) % 1000000 AS STRING), 6, '0')
    WHEN 'model_year' THEN CAST(1990 + k % 35 AS STRING)
    WHEN 'tax_or_id_no' THEN CAST(10000000000 + (k * 97 + c) % 89999999999 AS STRING)
    WHEN 'brand' THEN split_part('RENAULT,FORD,TOYOTA,HYUNDAI,FIAT,OPEL,PEUGEOT,DACIA', ',', CAST(k % 8 + 1 AS INT))
    WHEN 'type' THEN split_part('CLIO15,FOCUS2,C4X,GOLF7,EGEA14', ',', CAST(k % 5 + 1 AS INT))
    WHEN 'owner_surname' THEN split_part('YILMAZ,KAYA,DEMIR,CELIK,SAHIN,AYDIN', ',', CAST(c % 6 + 1 AS INT))
    WHEN 'owner_name' THEN split_part('AYSE,MEHMET,FATMA,ALI,ZEYNEP', ',', CAST(c % 5 + 1 AS INT))
    WHEN 'first_registration_date' THEN lpad(CAST(dd AS STRING), 2, '0') || '/' || lpad(CAST(mm AS STRING), 2, '0') || '/' || CAST(yy AS STRING)
    WHEN 'registration_date' THEN lpad(CAST(1 + k % 28 AS STRING), 2, '0') || '/' || lpad(CAST(mm AS STRING), 2, '0') || '/' || CAST(yy + 1 AS STRING)
    WHEN 'inspection_date' THEN lpad(CAST(1 + c % 28 AS STRING), 2, '0') || '/' || lpad(CAST(1 + k % 12 AS STRING), 2, '0') || '/' || CAST(yy + 2 AS STRING)
    ELSE CAST(100000 + k % 900000 AS STRING) END AS value,
  l.label, l.lx, l.ly, l.lw, l.vx, l.vy, l.vw
FROM (SELECT o_orderkey AS k, o_custkey AS c, extract(day FROM o_orderdate) AS dd, extract(month FROM o_orderdate) AS mm, extract(year FROM o_orderdate) AS yy FROM {orders}) o
CROSS JOIN (VALUES
  (0, 'plate', 'PLAKA', 100, 100, 120, 104, 150, 150), (1, 'brand', 'MARKASI', 100, 300, 120, 104, 335, 150), (2, 'type', 'TIPI', 420, 300, 70, 505, 302, 120),
  (3, 'model_year', 'MODEL YILI', 700, 300, 160, 704, 335, 60), (4, 'engine_no', 'MOTOR NO', 100, 440, 150, 104, 475, 150), (5, 'chassis_no', 'SASE NO', 100, 560, 140, 104, 592, 260),
  (6, 'tax_or_id_no', 'VERGI NO', 900, 60, 140, 1060, 62, 180), (7, 'owner_surname', 'SOYADI', 900, 140, 100, 1010, 142, 120), (8, 'owner_name', 'ADI', 900, 230, 50, 970, 232, 100),
  (9, 'first_registration_date', 'ILK TESCIL TARIHI', 420, 100, 260, 424, 150, 140), (10, 'registration_date', 'TESCIL TARIHI', 420, 200, 200, 424, 240, 140),
  (11, 'inspection_date', 'MUAYENE', 900, 700, 120, 904, 735, 140), (12, 'serial_no', 'BELGE SERI', 900, 830, 150, 904, 860, 100)
) AS l(field_no, field, label, lx, ly, lw, vx, vy, vw)
"""

LINES = f"""
SELECT page_id, 2 * field_no AS line_no, field,
  CASE WHEN page_id % 10 = 1 AND field IN ('model_year', 'engine_no', 'chassis_no', 'tax_or_id_no', 'serial_no') THEN replace(label, ' ', '')
       WHEN page_id % 10 = 2 AND field = 'engine_no' THEN 'M0T0R N0' ELSE label END AS text, lx AS x, ly AS y, lw AS w
FROM ({TRUTH}) t WHERE NOT (page_id % 10 = 4 AND field IN ('engine_no', 'serial_no'))
UNION ALL
SELECT page_id, 2 * field_no + 1, field,
  CASE WHEN page_id % 10 = 3 AND field = 'chassis_no' THEN substr(value, 1, 4) || replace(substr(value, 5), '0', 'O')
       WHEN page_id % 10 = 6 AND field LIKE '%date' THEN replace(value, '/', '.')
       WHEN page_id % 10 = 7 AND field = 'plate' THEN substr(value, 1, 2) || ' ' || substr(value, 3, 2) || ' ' || substr(value, 5)
       WHEN page_id % 10 = 8 AND field = 'serial_no' THEN 'SERI' || value
       WHEN page_id % 10 = 9 AND field = 'brand' THEN substr(value, 1, length(value) - 1) || 'I' ELSE value END, vx, vy, vw
FROM ({TRUTH}) t
UNION ALL
SELECT o_orderkey, 26, 'corner', 'X', 1580, 980, 20 FROM {{orders}}
"""


def layout_rows() -> list[tuple]:
    """The rows of the layout in TRUTH, as values."""
    inner = TRUTH[TRUTH.index("(VALUES") + 7 : TRUTH.index(") AS l(")]
    return list(ast.literal_eval("[" + inner.strip() + "]"))


def parts_of(sql: str) -> str:
    """The CASE expression of the first column that a query computes."""
    return sql[sql.index("CASE") : sql.index(" END AS ") + 4]


def page_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders, a page each, dealt out by page before they grow into lines and words: what follows goes by page_id and finds its rows together."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = orders.selectExpr("o_orderkey AS page_id", "o_custkey AS c", "day(o_orderdate) AS dd", "month(o_orderdate) AS mm", "year(o_orderdate) AS yy")
    return rows.repartition(orders.count() // PARTITION_PAGES + 1, "page_id")


def truth_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = spark.createDataFrame(layout_rows(), "field_no int, field string, label string, lx int, ly int, lw int, vx int, vy int, vw int")
    rows = page_keys(spark, sf_dir).join(F.broadcast(layout)).withColumn("k", F.col("page_id"))  # thirteen rows a page
    return rows.select("page_id", "field_no", "field", F.expr(parts_of(TRUTH).replace("l.field", "field")).alias("value"), "label", "lx", "ly", "lw", "vx", "vy", "vw")


def form_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, field, value: what each page says."""
    return truth_rows(spark, sf_dir).select("page_id", "field", "value")


def form_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and value lines of every page, and its corner; one row of the truth gives all of its lines."""
    labels, values, _ = LINES.split("UNION ALL")
    own, read = parts_of(labels), values[values.index("CASE") : values.index(" END,") + 4]
    line = "named_struct('line_no', {no}, 'text', {text}, 'x', CAST({x} AS int), 'y', CAST({y} AS int), 'w', CAST({w} AS int))"
    cells = [
        f"IF(page_id % 10 = 4 AND field IN ('engine_no', 'serial_no'), NULL, {line.format(no='2 * field_no', text=own, x='lx', y='ly', w='lw')})",
        line.format(no="2 * field_no + 1", text=read, x="vx", y="vy", w="vw"),
        f"IF(field_no = 0, {line.format(no='26', text=repr('X'), x='1580', y='980', w='20')}, NULL)",
    ]
    lines = truth_rows(spark, sf_dir).select("page_id", F.explode(F.expr(f"array({', '.join(cells)})")).alias("l")).where("l IS NOT NULL").select("page_id", "l.*")
    return lines.select("page_id", "line_no", "text", "x", "y", "w", F.lit(24).alias("h"), (60 + (F.col("page_id") * 7 + F.col("line_no") * 13) % 40).cast("double").alias("conf"))


def form_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_to_words(form_lines(spark, sf_dir))


def form_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of form_words, each of which has a word (its corner), and their size."""
    return pages(page_keys(spark, sf_dir))


def pages(words: DataFrame) -> DataFrame:
    return words.select("page_id").distinct().select("page_id", F.lit(PAGE_W).alias("doc_w"), F.lit(PAGE_H).alias("doc_h"))


# A page of mark-up whose labelled cells hold the truth, in portable SQL.
MARKUP = """
'<table><tr><td>(Y.I) VERILDIGI IL / ILCE</td><td>ESKISEHIR</td></tr><tr><td>(A) PLAKA</td><td>' || plate || '</td></tr><tr><td>(B) ILK TESCIL TARIHI</td><td>' || first_registration_date || '</td></tr><tr><td>(Y.2)</td></tr><tr><td>(I) TESCIL TARIHI</td><td>' || registration_date ||
'</td></tr><tr><td>(D.1) MARKASI</td><td>' || brand || '</td></tr><tr><td>(D.2) TIPI</td></tr><tr><td>(D.3) TICARI ADI</td><td>' || type || '</td></tr><tr><td>(D.4) MODEL YILI</td><td>' || model_year || '</td></tr><tr><td>(J)</td></tr><tr><td>(D.5) CINSI</td><td>OTOMOBIL</td></tr><tr><td>(R) RENGI</td><td>GRI</td></tr>' ||
'<tr><td>(P.5) MOTOR NO</td><td>' || engine_no || '</td></tr><tr><td>(E) SASE NO</td><td>' || chassis_no || '</td></tr><tr><td>(G.1)</td></tr><tr><td>(Y.4) T.C. KIMLIK NO/VERGI NO</td><td>' || CASE WHEN page_id % 10 = 4 THEN '' ELSE tax_or_id_no END || '</td></tr><tr><td>(C.1.1) SOYADI/TICARI UNVANI</td><td>' || owner_surname ||
'</td></tr><tr><td>(C.1.2) ADI</td><td>' || owner_name || '</td></tr><tr><td>(C.1.3) ADRESI</td></tr><tr><td>(Z.1)</td></tr><tr><td>(Z.2) DIGER BILGILER MUA.GEC.TRH:</td><td>' || inspection_date || '</td></tr><tr><td>(Z.3.4)</td></tr><tr><td>BELGE SERI. AB N° ' || serial_no || '</td></tr></table>'
"""


def form_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id and html: one table a page; every tenth page lacks its tax number."""
    truth = form_truth(spark, sf_dir)
    wide = truth.groupBy("page_id").pivot("field", [r[1] for r in layout_rows()]).agg(F.first("value"))
    return wide.select("page_id", F.expr(MARKUP).alias("html"))


def form_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' lines as recogniser payloads: one result for labels, one for values; polygons for the one, boxes for the other."""
    lines = form_lines(spark, sf_dir)
    corners = F.array(*[F.col(c).cast("double") for c in ("x", "y")], (F.col("x") + F.col("w")).cast("double"), (F.col("y") + F.col("h")).cast("double"))
    points = F.array(F.slice(corners, 1, 2), F.array(F.get(corners, 2), F.get(corners, 1)), F.slice(corners, 3, 2), F.array(F.get(corners, 0), F.get(corners, 3)))
    line = F.struct("line_no", "text", (F.col("conf") / 100).alias("score"), points.alias("points"), corners.alias("corners"))
    held = lines.groupBy("page_id", (F.col("line_no") % 2).alias("result_no")).agg(F.sort_array(F.collect_list(line)).alias("ls"))
    part = lambda name: F.transform("ls", lambda x: x[name])
    odd = F.col("result_no") == 1
    return held.select(
        "page_id", "result_no", part("text").alias("rec_texts"), part("score").alias("rec_scores"), F.when(~odd, part("points")).alias("rec_polys"), F.when(odd, part("corners")).alias("rec_boxes"),
        F.lit(None).cast("array<array<string>>").alias("text_word"), F.lit(None).cast("array<array<array<double>>>").alias("text_word_boxes"),
    )
