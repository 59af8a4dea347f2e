"""Sources, sinks, second pass, rescues, layouts and intake on small tables."""

import json

from pyspark.sql import functions as F

from formfields.operators import anchors as A
from formfields.operators import layout as L
from formfields.operators import second_pass as S
from formfields.operators import words as W
from formfields.operators.fields import needs_crop_reading, needs_secondary, resolve_rois
from formfields.operators.run import run_corpus
from formfields.plans.rules import FIELD_ORDER, anchor_rules, field_rules
from formfields.sources import forms, tables
from formfields.streaming import intake

WORDS = "page_id long, word_no int, text string, conf double, x int, y int, w int, h int, block_num int, par_num int, line_num int"
FIELDS = "page_id long, field string, value string, raw string, method string, confidence_score int, low_confidence boolean"


def words_at(spark, *cells):
    return spark.createDataFrame([(1, k, t, 90.0, x, y, 60, 20, 1, 1, k) for k, (t, x, y) in enumerate(cells)], WORDS)


def page(spark):
    return spark.createDataFrame([(1, 1000, 1000)], "page_id long, doc_w int, doc_h int")


def empty(spark, *fields):
    return spark.createDataFrame([(1, f, None, "", "empty_fallback", 0, True) for f in fields], FIELDS)


def test_second_pass(spark):
    words = words_at(spark, ("VERGI", 600, 50), ("12345678901", 620, 60), ("1234567890", 900, 250), ("MUAYENE", 600, 700), ("01.02.2024", 610, 720), ("1999", 300, 300), ("SERI881203", 700, 900), ("34ABC123", 100, 100))
    fields = empty(spark, "tax_or_id_no", "inspection_date", "model_year", "serial_no", "plate")
    found = {r.field: (r.value, r.method, r.confidence_score, r.low_confidence) for r in S.second_pass(words, page(spark), fields).collect()}
    # Half, .05 for eleven digits, .28 for the label beside it; a year without a label (.52) is below .55; the plate is not in the second pass.
    assert found["tax_or_id_no"] == ("12345678901", "page_second_pass_tax", 83, False)
    assert found["inspection_date"] == ("01/02/2024", "page_second_pass_inspection_date", 78, False)
    assert found["serial_no"] == ("881203", "page_second_pass_serial_merged", 94, False)
    assert found["model_year"][0] is None and found["plate"][0] is None
    more = {r.field: r.value for r in S.second_pass(words, page(spark), fields, {"plate": 0.5, "model_year": 0.5}).collect()}
    assert more["plate"] == "34ABC123" and more["model_year"] == "1999"


def test_label_bonus_by_distance(spark):
    found = spark.createDataFrame([(1, f"t{k}", "plate", 1000, 1000, x, 0, 0, 0, 0.5, True) for k, x in enumerate((80, 140, 200, 210))] + [(2, "none", "plate", 1000, 1000, 0, 0, 0, 0, 0.5, True)], "page_id long, value string, field string, doc_w int, doc_h int, x int, y int, w int, h int, base double, labelled boolean")
    labels = spark.createDataFrame([(1, "PLAKA", 0, 0, 0, 0)], "page_id long, norm string, x int, y int, w int, h int")
    assert {r.value: round(r.score - 0.5, 2) for r in S.label_bonus(found, labels).collect()} == {"t0": 0.28, "t1": 0.18, "t2": 0.10, "t3": 0.0, "none": 0.0}


def test_chassis_of_two_words(spark):
    words = words_at(spark, ("VF1LB0000", 100, 500), ("12345678", 180, 505), ("VF1LB", 100, 700))
    found = S.second_pass_best(S.second_pass_candidates(words, page(spark), ["chassis_no"]), {"chassis_no": 0.55}).collect()
    assert [(r.value, r.raw, round(r.score, 2), r.w) for r in found] == [("VF1LB000012345678", "VF1LB000012345678", 0.87, 140)]


def test_rescues(spark):
    words = words_at(spark, ("2012", 700, 850), ("AB12345", 700, 860), ("SeriNo881203", 700, 900), ("D3TICARI", 100, 500), ("EG37672", 100, 600), ("K9K17R12", 100, 700), ("ABC12345", 100, 400), ("MOTORNO", 100, 450))
    assert S.serial_rescue(words, page(spark), empty(spark, "serial_no")).first().value == "881203"
    assert S.engine_rescue(words, page(spark), empty(spark, "engine_no")).first()[:6] == (1, "engine_no", "K9K17R12", "K9K17R12", "v31_engine_page_rescue", 55)
    kept = empty(spark, "serial_no").withColumn("value", F.lit("7777"))
    assert S.serial_rescue(words, page(spark), kept).first().value == "7777"
    assert S.serial_rescue(words.where("false"), page(spark), empty(spark, "serial_no")).first().value is None


def test_work_lists(spark):
    rules = field_rules(spark)
    fields = spark.createDataFrame([(1, "owner_name", "MAH ALI", "", "m", 9, False), (1, "brand", "FIAT", "", "m", 5, False), (1, "type", "ADI C4X", "", "m", 20, False), (1, "plate", None, "", "m", 0, True), (1, "serial_no", "1234", "", "m", 4, False)], FIELDS)
    assert {r.field for r in needs_secondary(fields).collect()} == {"owner_name", "type", "plate"}
    assert {r.field for r in needs_secondary(fields, 5).collect()} == {"owner_name", "type", "plate", "serial_no"}
    assert needs_crop_reading(fields, rules, "disabled").count() == 0 and needs_crop_reading(fields, rules, "always").count() == 5
    assert {"plate", "serial_no"} <= {r.field for r in needs_crop_reading(fields, rules).collect()}


def test_rules_with_defaults_and_violations(spark, tmp_path):
    anchors = [{"anchor": "a"}, {"anchor": "b", "aliases": ["B B"], "min_score": 0.5, "search_region_norm": [0, 0, 1]}, {"anchor": "c", "search_region_norm": [0.0, 0.0, 1.0, 0.5]}]
    fields = [{"field": "plate", "anchor": "a", "cleanup": "plate", "offset_from_anchor_norm": [0, 0, 0.1, 0.1]}, {"field": "x"}, {"field": "x"}, {"anchor": "a"}]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, anchors)))
    (tmp_path / "f.json").write_text("\n".join(map(json.dumps, fields)))
    a, f, wrong = tables.read_rules(spark, f"{tmp_path}/a.json", f"{tmp_path}/f.json")
    assert [(r.anchor, r.min_score, r.aliases, r.rh) for r in a.orderBy("anchor").collect()] == [("a", 0.72, ["a"], None), ("c", 0.72, ["c"], 0.5)]
    assert [(r.field, r.strategy, r.direction, r.mr, r.dw, r.prefixes) for r in f.collect()] == [("plate", "plate", "below", 0.22, 0.1, [])]
    assert sorted((r.table, r.name or "", r.column, r.problem) for r in wrong.collect()) == [("anchors", "b", "search_region_norm", "not four numbers"), ("fields", "", "field", "no name"), ("fields", "x", "field", "repeats"), ("fields", "x", "field", "repeats")]


def test_words_payloads_and_results_round_trip(spark, tmp_path):
    words = words_at(spark, ("ŞASE", 10, 10), ("NO", 80, 10), ("VF1", 10, 40))
    tables.write_words(words, page(spark), f"{tmp_path}/csv")
    back = tables.read_words(spark, f"{tmp_path}/csv").orderBy("word_no").collect()
    assert [(r.text, r.x, r.y, r.conf, r.line_num) for r in back] == [("ŞASE", 10, 10, 90.0, 0), ("NO", 80, 10, 90.0, 1), ("VF1", 10, 40, 90.0, 2)]
    items = [{"page_id": 1, "res": {"rec_texts": ["AB CDE", " ", "low"], "rec_scores": [0.9, 0.9, 0.1], "rec_polys": [[[0.2, 5.5], [99.5, 5.1], [100.0, 20.0], [0.0, 20.0]]] * 3}},
             {"page_id": 1, "result_no": 1, "rec_texts": ["XY Z", "none"], "rec_scores": [95.0], "rec_boxes": [[50, 40, 10, 60], []], "text_word": [["XY", "", "Z"]], "text_word_boxes": [[[10, 40, 30, 60], [0, 0, 1, 1], [35, 40, 50, 60]]]}, {"page_id": 2, "other": 1}]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, items)))
    payloads = tables.read_line_payloads(spark, f"{tmp_path}/p.json")
    found = [(r.text, r.conf, r.x, r.y, r.w, r.h, r.line_num) for r in W.payload_to_words(payloads, 20.0).orderBy("word_no").collect()]
    assert found == [("AB", 90.0, 0, 5, 40, 15, 1), ("CDE", 90.0, 40, 5, 60, 15, 1), ("XY", 95.0, 10, 40, 20, 20, 2), ("Z", 95.0, 35, 40, 15, 20, 2)]
    assert W.payload_text(payloads).first().text == "AB CDE\nlow\nXY Z\nnone"
    fields = spark.createDataFrame([(7, "plate", "34AB123", "34 AB 123", "m", 20, False), (7, "brand", None, "", "m", 0, True)], FIELDS)
    anchors = spark.createDataFrame([(7, "plate_label", "PLAKA", 0.98765, 1, 2, 3, 4)], "page_id long, anchor string, alias string, score double, ax int, ay int, aw int, ah int")
    tables.write_documents(tables.to_documents(fields, anchors), f"{tmp_path}/docs")
    wide = tables.wide_results(tables.read_results(spark, f"{tmp_path}/docs"), FIELD_ORDER).collect()
    assert [(r.image, r.plate, r.brand) for r in wide] == [("page-7", "34AB123", "")]
    assert tables.to_documents(fields, mode="fields").first().fields == {"plate": "34AB123", "brand": None}
    assert tables.to_documents(fields, anchors, "runtime").first().n_anchors == 1
    tables.write_wide(tables.wide_results(tables.read_results(spark, f"{tmp_path}/docs"), FIELD_ORDER), f"{tmp_path}/wide")
    assert spark.read.option("header", True).csv(f"{tmp_path}/wide").columns == ["image", *FIELD_ORDER]
    (tmp_path / "named").mkdir()
    (tmp_path / "named" / "a.json").write_text(json.dumps({"image": "c:\\x\\y.png", "fields": {}}))
    (tmp_path / "named" / "b.json").write_text(json.dumps({"fields": {"plate": {"value": "P"}}}))
    (tmp_path / "named" / "Timing_Summary.json").write_text("{}")
    assert sorted((r.image, r.plate) for r in tables.wide_results(tables.read_results(spark, f"{tmp_path}/named"), FIELD_ORDER).collect()) == [("b.jpeg", "P"), ("y.png", "")]


def test_merging_with_template_hits(spark):
    found = spark.createDataFrame([(1, "a", "A", 1.0, 0, 0, 1, 1)], "page_id long, anchor string, alias string, score double, ax int, ay int, aw int, ah int")
    hits = spark.createDataFrame([(1, "a", "f", 0.9, 5, 5, 1, 1), (1, "b", "g", 0.7, 6, 5, 1, 1), (1, "b", "f", 0.7, 5, 5, 1, 1), (1, "c", "f", 0.6, 5, 5, 1, 1), (1, "d", "f", 0.65, 5, 5, 1, 1)], "page_id long, anchor string, template_file string, score double, x int, y int, w int, h int")
    assert {r.anchor: r.alias for r in A.merge_anchors(found, hits, own_least={"c": 0.5, "d": 0.7}).collect()} == {"a": "A", "b": "[template:f]", "c": "[template:f]"}


def test_anchor_debug(spark):
    rules = spark.createDataFrame([(0, "engine", 0.7, ["MOTOR NO", "MOTORNO"], None, None, None, None)], "anchor_no int, anchor string, min_score double, aliases array<string>, rx double, ry double, rw double, rh double")
    found = {r.word_text: (r.best_alias, r.best_alias_token_score, r.best_alias_pass) for r in A.anchor_debug(words_at(spark, ("MOTOR", 0, 0), ("M0TORNO", 0, 30), ("...", 0, 60)), rules).collect()}
    assert found == {"MOTOR": ("MOTOR NO", 1.0, 1), "M0TORNO": ("MOTORNO", 0.8571, 1), "...": ("", 0.0, 0)}


def test_layouts(spark):
    block = "struct<content:string,text:string,markdown:string,md:string>"
    rows = [(1, [[{"content": "```markdown\nA  b```"}, {"text": "A b", "md": "c"}], [{"content": " "}, {"content": "d"}]]), (2, None)]
    table = spark.createDataFrame(rows, f"page_id long, blocks array<array<{block}>>")
    assert {r.page_id: r.text for r in L.flatten_layout(table).collect()} == {1: "A b\nc\nd", 2: ""}
    assert {r.page_id: r.text for r in L.blocks_text(table.where("page_id = 1")).collect()} == {1: "```markdown\nA  b```\n\nd"}


def test_summary_records(spark):
    text = "VERILDIGI IL / ILCE ESKISEHIR<br>34ABC123 B ILK TESCIL TARIHI 01/02/2003 I TESCIL TARIHI 04/05/2006<br>D.1 MARKASI RENAULT D.2 TIPI KW05 D.3 TICARI ADI CLIO D.4 MODEL YILI 2003 ARAC SINIFI M1 OTOMOBIL GRI (MET) K9K7770123 VF1AAAAAAAAAAAAAA" \
        "<br>SILINDIR HACMI 1461 CM3 MOTOR GUCU 65 KW T.C. KIMLIK NO/VERGI NO 12345678901 C.1.1 SOYADI/TICARI UNVANI KAYA C.1.2 ADI ALI C.1.3 ADRESI ULUONDER MAH Z.1 ARAC UZERINDE HAK MUA.GEC.TRH: 01-02-2024 ONAYLAYAN SICIL-IMZA Veli Can S.N.Y.42 BELGE SERI AB N° 881203"
    pages = spark.createDataFrame([(1, text), (2, "no form"), (3, None), (4, text.replace("KIMLIK", "K"))], "page_id long, html string")
    found = L.summary_records(pages).collect()
    assert len(found) == 1
    r = found[0].asDict()
    assert (r["plate"], r["brand"], r["type"], r["model_year"], r["engine_no"], r["chassis_no"]) == ("34ABC123", "RENAULT", "CLIO", "2003", "K9K7770123", "VF1AAAAAAAAAAAAAA")
    assert (r["vehicle_class"], r["color"], r["displacement"], r["power"], r["owner_name"], r["owner_surname"], r["address"]) == ("OTOMOBİL", "GRİ (MET)", "1461", "65", "ALI", "KAYA", "ULUÖNDER MAH")
    assert (r["place"], r["inspection_date"], r["serial_no"], r["approver"], r["first_registration_date"], r["registration_date"]) == ("ESKİŞEHİR", "01-02-2024", "AB 881203", "Veli Can (S.N.Y.42)", "01/02/2003", "01/02/2003")


def test_stream_equals_batch(spark, tmp_path):
    """Files of whole pages, taken in one after the other, give what one batch over all gives; a batch that runs again replaces itself."""
    rows = spark.sql("SELECT id AS o_orderkey, id * 3 + 1 AS o_custkey, date_add(DATE'1995-01-01', CAST(id AS int)) AS o_orderdate FROM VALUES (2L), (7L) t(id)")
    rows.write.parquet(f"{tmp_path}/orders.parquet")
    words = forms.form_words(spark, str(tmp_path)).select([F.col(c.split()[0]).cast(c.split()[1]) for c in intake.WORDS.split(", ")]).persist()
    for p in (2, 7):
        words.where(f"page_id = {p}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    plan = lambda w: resolve_rois(forms.pages(w), field_rules(spark), A.match_anchors(w, anchor_rules(spark), exact=True))
    stream = intake.stream_words(spark, f"{tmp_path}/in")
    intake.run_intake(stream, plan, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    key = lambda df: sorted(tuple(r) for r in df.select("page_id", "field", "rx", "ry", "rw", "rh").collect())
    assert key(spark.read.parquet(f"{tmp_path}/out")) == key(plan(words))
    assert intake.running_metrics(spark.createDataFrame([(1, 10.0), (2, 20.04)], "request_id long, latency_ms double")).first() == (2, 15.0)


def test_whole_run(spark, tmp_path):
    """One page of each noise class: all but what the rules themselves miss is right."""
    rows = spark.sql("SELECT id AS o_orderkey, id * 3 + 1 AS o_custkey, date_add(DATE'1995-01-01', CAST(id AS int)) AS o_orderdate FROM range(10, 20)")
    rows.write.parquet(f"{tmp_path}/orders.parquet")
    words = forms.form_words(spark, str(tmp_path)).persist()
    anchors = A.match_anchors(words, anchor_rules(spark)).persist()
    out = run_corpus(words, forms.pages(words), field_rules(spark), anchors)
    met = out.join(forms.form_truth(spark, str(tmp_path)).withColumnRenamed("value", "truth"), ["page_id", "field"]).where("NOT (value <=> truth)").collect()
    assert {(r.page_id, r.field) for r in met if r.field != "owner_name"} == {(14, "engine_no")}
    assert all(r.truth == "ALI" and r.value is None for r in met if r.field == "owner_name")
