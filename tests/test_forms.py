"""Pinned cases of the form operators."""

from pyspark.sql import functions as F

from formfields import entries
from formfields.functions.text import clean_date, clean_digits, clean_plate, fixed_date, fixed_vin
from formfields.operators.anchors import match_anchors
from formfields.operators.fields import apply_secondary, compare_runs, plate_candidates, validate
from formfields.operators.words import clean_words, lines_to_words, page_skew
from formfields.plans.rules import field_rules


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_standard_values(spark):
    assert one(spark, clean_plate(F.lit("34 abc 123"))) == "34ABC123"
    assert one(spark, clean_date(F.lit("1.2.24"))) == "01/02/2024"
    assert one(spark, clean_digits(F.lit("12 3456 7890"))) == "3456"
    assert one(spark, fixed_date(F.lit("31/13/2020"))) is None
    assert one(spark, fixed_vin(F.lit("VF1OQI00000000000"))) == "VF100100000000000"


def test_line_split(spark):
    lines = spark.createDataFrame([(1, 0, "AB CDE", 0, 0, 100, 20, 90.0), (1, 1, "  ", 0, 30, 50, 20, 90.0)], "page_id long, line_no int, text string, x int, y int, w int, h int, conf double")
    words = lines_to_words(lines).orderBy("word_no").collect()
    assert [(w.text, w.x, w.w) for w in words] == [("AB", 0, 40), ("CDE", 40, 60)]


def test_blank_and_unsure_words(spark):
    words = spark.createDataFrame([("a", "90"), (" ", "90"), ("b", "-"), ("c", "5")], "text string, conf string")
    assert [w.text for w in clean_words(words, 10.0).collect()] == ["a"]


def test_skew_of_nothing(spark):
    words = spark.createDataFrame([(1, 0, 0, 0, 10, 10, 1, 1, 0)], "page_id long, word_no int, x int, y int, w int, h int, block_num int, par_num int, line_num int")
    assert page_skew(words).first().skew_angle_deg == 0.0


def test_abstain_and_secondary(spark):
    schema = "page_id long, field string, value string, raw string, method string, confidence_score int, low_confidence boolean"
    fields = spark.createDataFrame([(1, "inspection_date", "31/13/2020", "31/13/2020", "roi_line", 100, False), (1, "owner_name", "ALI", "ALI", "roi_line", 3, True)], schema)
    done = {r.field: r for r in validate(fields).collect()}
    assert done["inspection_date"].value is None and done["inspection_date"].abstain_reason == "postprocess_validation_failed"


def test_secondary_readings(spark):
    """Only asked for where a field needs it; blank ones empty the field, ones that clean to nothing leave it, others are cleaned, filtered and scored."""
    schema = "page_id long, field string, value string, raw string, method string, confidence_score int, low_confidence boolean"
    fields = spark.createDataFrame([(p, "owner_name", "ALI", "ALI", "roi_line", 3, True) for p in range(1, 5)] + [(5, "owner_name", "MEHMET", "MEHMET", "roi_line", 6, False), (6, "type", None, None, "empty_fallback", 0, True)], schema)
    readings = spark.createDataFrame([(1, "owner_name", "x EMPTY_PATCH"), (2, "owner_name", "Adı: Mehmet Ali"), (3, "owner_name", "LTD"), (4, "owner_name", " "), (5, "owner_name", "VELI"), (6, "type", "TIPI C4X")], "page_id long, field string, raw string")
    read = {r.page_id: (r.value, r.raw, r.method, r.confidence_score, r.low_confidence, r.secondary_applied) for r in apply_secondary(fields, readings, field_rules(spark)).collect()}
    assert read[1] == (None, "", "glm_roi_fallback", 100, False, True) and read[4] == (None, "", "glm_roi_fallback", 100, False, True)
    assert read[2] == ("MEHMET ALI", "Adı: Mehmet Ali", "glm_roi_fallback", 9, False, True)
    assert read[3] == ("ALI", "ALI", "roi_line", 3, True, False) and read[5] == ("MEHMET", "MEHMET", "roi_line", 6, False, False)
    assert read[6] == ("C4X", "TIPI C4X", "glm_roi_fallback", 11, False, True)


def test_compare_runs(spark):
    a = spark.createDataFrame([(1, "brand", "FORD"), (1, "type", "C4X"), (2, "brand", None)], "page_id long, field string, value string")
    b = spark.createDataFrame([(1, "brand", "FIAT"), (2, "brand", None)], "page_id long, field string, value string")
    assert {(r.page_id, r.field): r.state for r in compare_runs(a, b).collect()} == {(1, "brand"): "changed", (1, "type"): "only_left", (2, "brand"): "same"}


def test_labels_exact_and_fuzzy(spark):
    """Equal phrases win at once; near ones are compared; the bound drops only what can't reach the least score."""
    words = "page_id long, word_no int, text string, conf double, x int, y int, w int, h int, block_num int, par_num int, line_num int"
    texts = [(1, ["MOTOR", "NO"]), (2, ["M0T0RNO"]), (3, ["KLIMA", "CAM"]), (4, ["MOTQR", "NO"]), (5, ["NO"])]
    table = spark.createDataFrame([(p, k, t, 90.0, 10 + 100 * k, 10, 90, 20, 1, 1, 0) for p, ts in texts for k, t in enumerate(ts)], words)
    rules = spark.createDataFrame([(0, "engine", 0.7, ["MOTOR NO"], None, None, None, None)], "anchor_no int, anchor string, min_score double, aliases array<string>, rx double, ry double, rw double, rh double")
    found = {r.page_id: (round(r.score, 3), r.ax, r.aw) for r in match_anchors(table, rules).collect()}
    assert found == {1: (1.0, 10, 190), 2: (0.714, 10, 90), 4: (0.9, 10, 190)}
    assert {r.page_id for r in match_anchors(table, rules, exact=True).collect()} == {1}
    assert match_anchors(table.where("false"), rules).count() == 0


def test_plates_from_page_words(spark):
    words = "page_id long, word_no int, text string, conf double, x int, y int, w int, h int, block_num int, par_num int, line_num int"
    near, far = [(1, k, t, 90.0, 100 + 60 * k, 150, 50, 24, 1, 1, 0) for k, t in enumerate(["34", "ab", "123"])], (1, 3, "06XY99", 90.0, 900, 400, 80, 24, 1, 1, 1)
    unsure, tail = (2, 0, "34AB123", 5.0, 100, 150, 50, 24, 1, 1, 0), (3, 0, "15DCI65", 90.0, 100, 150, 80, 24, 1, 1, 0)
    table = spark.createDataFrame([*near, far, unsure, tail], words)
    pages = spark.createDataFrame([(p, 1600, 1000) for p in (1, 2, 3)], "page_id long, doc_w int, doc_h int")
    rois = spark.createDataFrame([(p, "plate", 100, 140, 200, 60) for p in (1, 2, 3)], "page_id long, field string, rx int, ry int, rw int, rh int")
    found = {r.page_id: (r.value, r.score) for r in plate_candidates(table, pages, rois).collect()}
    # Seven characters, 12 for the pattern, 12 for the place; distances round to 0 (10 * (60 / 1600 + 8 / 1000) on page 3); 12 off for a type's tail.
    assert found == {1: ("34AB123", 31), 3: ("15DCI65", 19)}
    assert plate_candidates(table.where("false"), pages, rois).count() == 0


def test_labels_with_misread_characters_have_lines(spark, tmp_path, monkeypatch):
    """Pages whose id ends in 2 have the label M0T0R N0, which equals no alias; their best lines need fuzzy labels, and the wide rows ask for them."""
    rows = spark.sql("SELECT id AS o_orderkey, id * 3 + 1 AS o_custkey, date_add(DATE'1995-01-01', CAST(id AS int)) AS o_orderdate FROM VALUES (2L), (5L), (12L) t(id)")
    rows.write.parquet(f"{tmp_path}/orders.parquet")
    truth = {r.page_id: r.value for r in entries.q_form_truth(spark, str(tmp_path)).where("field = 'engine_no'").collect()}
    found = {r.page_id: r.raw for r in entries.q_best_lines(spark, str(tmp_path)).where("field = 'engine_no'").collect()}
    assert found[2] == truth[2] and found[12] == truth[12]
    asked = []
    monkeypatch.setattr(entries.A, "match_anchors", lambda words, rules, exact=False: asked.append(exact) or match_anchors(words, rules, exact))
    entries.entry(spark, str(tmp_path))
    assert asked == [False]
