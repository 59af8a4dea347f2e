"""Pages as rows, boxes, rule sets, crop readings, pairs of strings, nested layouts and counters of streams."""

import json

import pytest
from pyspark.sql import functions as F

from formfields.operators import anchors as A
from formfields.operators import extraction as X
from formfields.operators import fields as V
from formfields.operators import layout as L
from formfields.operators import page_rows as P
from formfields.operators import second_pass as S
from formfields.operators.brands import brand_key, nearest_brand, nearest_brands
from formfields.operators.candidates import region_candidates
from formfields.operators.run import run_corpus, run_rule_sets
from formfields.plans.rules import ANCHORS, BRANDS, FIELDS, POST_CLEAN, anchor_rules, field_rules
from formfields.scratch import clear_written, dropped, scratch, written
from formfields.sources import forms, tables
from formfields.streaming import intake

BOX = "struct<x:int,y:int,w:int,h:int>"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Three pages of each noise class, their labels, and words that lie across lines and regions."""
    at = str(tmp_path_factory.mktemp("corpus"))
    spark.sql("SELECT id AS o_orderkey, id * 3 + 1 AS o_custkey, date_add(DATE'1995-01-01', CAST(id AS int)) AS o_orderdate FROM range(10, 40)").write.parquet(f"{at}/orders.parquet")
    words = forms.form_words(spark, at)
    noise = words.where("page_id % 4 = 1 AND word_no % 5 = 0").withColumns({"word_no": F.col("word_no") + 100, "y": F.col("y") + 7, "x": F.col("x") + 40, "text": F.concat(F.lit("K"), "text"), "line_num": F.lit(77)})
    words = written(words.unionByName(noise), "words")
    labels = written(A.match_anchors(words, anchor_rules(spark)), "labels")
    return at, words, forms.pages(words), labels


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_pages_as_rows_give_the_candidates_of_words_as_rows(spark, corpus):
    _, words, pages, labels = corpus
    rules = field_rules(spark)
    found = written(P.page_candidates(P.page_table(words, pages, labels), rules), "candidates")
    rois = V.resolve_rois(pages, rules, labels)
    flat = ["page_id", "field", "method", "raw", F.col("value_box.x"), F.col("value_box.y"), F.col("value_box.w"), F.col("value_box.h")]
    for method, old in (("anchor", V.best_lines(words, V.value_windows(pages, rules, labels))), ("roi_line", V.best_roi_lines(words, rois))):
        assert rows(found.where(F.startswith("method", F.lit(method))), *flat) == rows(old, "page_id", "field", "method", "raw", "x", "y", "w", "h")
    for method, old in (("semantic_plate_page_words", V.plate_candidates(words, pages, rois)), ("semantic_", region_candidates(words, rois))):
        mine = found.where(F.startswith("method", F.lit(method)) & ((F.lit(method) != "semantic_") | (F.col("method") != "semantic_plate_page_words")))
        assert rows(mine, "page_id", "field", "method", "raw") == rows(old, "page_id", "field", "method", "raw")
    assert rows(found.where("roi IS NOT NULL").select("page_id", "field", "roi.*").distinct(), "page_id", "field", "x", "y", "w", "h") == rows(rois, "page_id", "field", "rx", "ry", "rw", "rh")
    assert found.select("page_id", "field").distinct().count() == 30 * 13


def test_fields_carry_their_boxes_into_documents(spark, corpus):
    at, words, pages, labels = corpus
    out = written(run_corpus(words, pages, field_rules(spark), labels), "run")
    truth = forms.truth_rows(spark, at)
    met = out.join(truth.select("page_id", "field", F.col("value").alias("truth"), "vx", "vy"), ["page_id", "field"]).where("value = truth AND page_id % 4 <> 1")
    assert met.count() > 200
    # A value's box is that of its line, as it stands on the page.
    assert met.where("value_box.x = vx AND value_box.y = vy").count() > 0.9 * met.count()
    about = tables.run_metadata(pages, spark.createDataFrame([(10, 1.5)], "page_id long, skew_angle_deg double"), spark.createDataFrame([(10, 2.5)], "page_id long, seconds double"))
    doc = tables.to_documents(out, labels, "document", about).where("page_id = 10").first()
    assert doc.fields["plate"].roi.w > 1 and doc.fields["plate"].value_bbox.x == 104 and doc.anchors["plate_label"].bbox.x == 100
    assert doc.pipeline.skew_angle_deg == 1.5 and doc.pipeline.output_width == 1600 and doc.runtime.seconds == 2.5
    short = tables.to_documents(out, labels, "runtime", about).where("page_id = 11").first()
    assert short.n_anchors > 5 and short.runtime.seconds is None and short.pipeline.skew_angle_deg == 0.0
    assert "runtime" not in tables.to_documents(out, labels, "fields", about).columns


def rule_table(spark, schema, found):
    return spark.createDataFrame([tuple(r.get(c.split()[0]) for c in schema.split(", ")) for r in found], schema)


def test_loaded_rule_sets_in_one_pass(spark, corpus, tmp_path):
    """Of three sets read from files the first gives what the built-in rules give; the others obey prefer_anchor and whitelist."""
    _, words, pages, labels = corpus
    sets = {"a": {}, "b": {"prefer_anchor": False}, "c": {"whitelist": "ALIVE"}}
    files = {"anchors": [], "fields": []}
    for name, change in sets.items():
        anchors, fields = tables.rule_documents(ANCHORS, FIELDS, POST_CLEAN, name)
        files["anchors"] += anchors
        files["fields"] += [f | change for f in fields]
    for kind, found in files.items():
        (tmp_path / f"{kind}.json").write_text("\n".join(map(json.dumps, found)))
    anchors, fields, violations = tables.read_rules(spark, f"{tmp_path}/anchors.json", f"{tmp_path}/fields.json")
    assert violations.count() == 0
    assert [r.anchor for r in anchors.where("rule_set = 'b'").orderBy("anchor_no").collect()] == [a[0] for a in ANCHORS]
    truth = forms.form_truth(spark, corpus[0])
    crops = truth.where("field = 'owner_name'").select("page_id", "field", F.lit("raw").alias("variant"), F.lit("ALI VELI 12").alias("raw"))
    out = written(run_rule_sets(words, pages, anchors, fields, crops=crops), "sets")
    columns = ["page_id", "field", "value", "raw", "method", "confidence_score", "low_confidence", "roi", "value_box", "abstain_reason"]
    assert rows(out.where("rule_set = 'a'"), *columns) == rows(run_corpus(words, pages, field_rules(spark), labels, crops=crops), *columns)
    methods = {name: {r.method for r in out.where(F.col("rule_set") == name).select("method").distinct().collect()} for name in sets}
    assert any(m.startswith("anchor_") for m in methods["a"]) and not any(m.startswith("anchor_") for m in methods["b"])
    read = lambda name: {r.raw for r in out.where((F.col("rule_set") == name) & (F.col("method") == "roi_tesseract_raw")).collect()}
    assert read("a") == {"ALI VELI 12"} and read("c") == {"ALIVELI"}
    states = {(r.field, r.state) for r in V.compare_runs(out.where("rule_set = 'a'"), out.where("rule_set = 'c'")).groupBy("field", "state").count().collect()}
    assert ("plate", "same") in states and ("plate", "changed") not in states


def test_violations_of_rules(spark):
    good = {"rule_set": "s", "anchor": "p", "search_region_norm": [0.0, 0.0, 1.0, 1.0]}
    anchors = rule_table(spark, tables.ANCHOR_RULES, [good, {"rule_set": "t", "anchor": "p"}, {"rule_set": "s", "anchor": "q", "search_region_norm": [0.0]}, {"rule_set": "s", "anchor": None}])
    fields = rule_table(spark, tables.FIELD_RULES, [{"field": "f", "anchor": "p"}, {"field": "f", "anchor": "q"}, {"field": "g", "offset_from_anchor_norm": [0.0, None, 0.0, 0.0]}, {"rule_set": "s", "field": "f", "anchor": "p"}])
    kept, rules, wrong = tables.load_rules(anchors, fields)
    assert {(r.rule_set, r.anchor, r.anchor_no, r.min_score) for r in kept.collect()} == {("s", "p", 0, 0.72), ("t", "p", 0, 0.72)}
    assert [(r.rule_set, r.field, r.prefer_anchor, r.strategy, r.whitelist) for r in rules.collect()] == [("s", "f", True, "keep", None)]
    assert {(r.rule_set, r.table, r.name, r.column, r.problem) for r in wrong.collect()} == {
        ("s", "anchors", "q", "search_region_norm", "not four numbers"), ("s", "anchors", None, "anchor", "no name"), ("", "fields", "f", "field", "repeats"), ("", "fields", "g", "offset_from_anchor_norm", "not four numbers"),
    }


SCORED = f"page_id long, field string, roi {BOX}, method string, raw string, priority int, cand_no int, value string, score int, threshold int, force_method string, value_box {BOX}"


def test_choice_of_forced_methods_and_ties(spark):
    box = lambda k: (k, k, k, k)
    found = spark.createDataFrame([
        (1, "a", box(9), "other", "x", 1, 1, "high", 20, 0, "forced", box(1)), (1, "a", box(9), "forced", "x", 1, 2, "low", 5, 0, "forced", box(2)),
        (1, "b", box(9), "m", "x", 1, 3, "third", 7, 5, None, box(3)), (1, "b", box(9), "n", "x", 2, 4, "first", 7, 5, None, box(4)), (1, "b", box(9), "o", "x", 2, 5, "second", 7, 5, None, box(5)),
        (1, "c", box(9), "m", "short", 1, 1, "v", 4, 5, None, box(6)), (1, "c", box(9), "m", "none", 1, 2, None, 50, 5, None, box(7)),
        (1, "d", None, None, None, None, None, None, 0, 0, "forced", None),
    ], SCORED)
    got = {r.field: (r.value, r.method, r.confidence_score, r.low_confidence, r.value_box and r.value_box.x) for r in X.choose(found).collect()}
    assert got == {"a": ("low", "forced", 5, False, 2), "b": ("first", "n", 7, False, 4), "c": (None, "empty_fallback", 0, True, 9), "d": (None, "empty_fallback", 0, False, None)}


def test_second_choice_is_gated(spark):
    rules = field_rules(spark)
    box = (1, 2, 3, 4)
    scored = spark.createDataFrame([(p, "tax_or_id_no", roi, "roi_line", v, 3, 4, v, len(v), 9, None, box) for p, v, roi in ((1, "12345678901", box), (2, "123", box), (3, "123", None))], SCORED)
    crops = spark.createDataFrame([(p, "tax_or_id_no", "preprocessed", "99999999999") for p in (1, 2, 3)] + [(2, "tax_or_id_no", "unknown", "11111111111")], "page_id long, field string, variant string, raw string")
    first = X.choose(scored)
    read = lambda mode: {r.page_id: r.value for r in X.second_choice(scored, first, crops, rules, mode).collect()}
    assert read("fallback") == {1: "12345678901", 2: "99999999999", 3: None}
    assert read("disabled") == {1: "12345678901", 2: None, 3: None}
    assert read("always") == {1: "12345678901", 2: "99999999999", 3: None}


def test_pairs_are_compared_once(spark):
    pairs = spark.createDataFrame([("M0T0RNO", "MOTORNO"), ("M0T0RNO", "MOTORNO"), ("AB", "XY")], "p string, q string")
    assert {(r.p, r.q): round(r.similarity, 3) for r in A.similar_pairs(pairs).collect()} == {("M0T0RNO", "MOTORNO"): 0.714, ("AB", "XY"): 0.0}
    keys = ["FIAT", "FIAI", "MERCEDESBENZ", "HYUNDAI1", "QQQQ", "REN", "FORI", "RENAULTX", "KIA", "KI", "SEATX", "TOYO", "CITY", "VOLKS", "MONDIALS"]
    found = {r.key: r.brand for r in nearest_brands(spark.createDataFrame([(k,) for k in keys], "key string")).collect()}
    assert found == {k: b for k in keys if (b := nearest_brand(k, BRANDS))}
    assert spark.createDataFrame([("MARKASI Fıat 15",)], "v string").select(brand_key(F.col("v"))).first()[0] == "FIAT15"


def test_equal_hits_count_once(spark):
    hits = spark.createDataFrame([(1, "a", 5, 2, "late"), (1, "a", 5, 1, "first"), (1, "a", 6, 3, "elsewhere"), (1, "b", 5, 0, "other")], "page_id long, value string, x int, word_no int, method string")
    assert sorted(r.method for r in S.distinct_hits(hits, ["page_id", "value", "x"], ["word_no"]).collect()) == ["elsewhere", "first", "other"]
    words = spark.createDataFrame([(1, k, "12345678901 12345678901", 90.0, 620, 60, 60, 20, 1, 1, k) for k in (0, 1)], "page_id long, word_no int, text string, conf double, x int, y int, w int, h int, block_num int, par_num int, line_num int")
    found = S.second_pass_candidates(words, spark.createDataFrame([(1, 1000, 1000)], "page_id long, doc_w int, doc_h int"), ["tax_or_id_no"]).collect()
    assert [(r.word_no, r.hit_no) for r in found] == [(0, 0)]


def walked(value, top=True):
    """The texts of a layout by a walk in Python."""
    if isinstance(value, str):
        return [value]
    if isinstance(value, list):
        return [t for v in value for t in walked(v)]
    if isinstance(value, dict):
        return [value[k] for k in L.TEXTS if isinstance(value.get(k), str)] + [t for k, v in value.items() if k not in L.NO_TEXT for t in walked(v)]
    return []


def test_layouts_of_any_depth(spark):
    deep = "end"
    for k in range(12):
        deep = {"z": [deep, f"item {k}"]} if k % 2 else [{"own": deep}]
    layouts = [
        {"title": "T", "content": "c1", "zz": {"md": " m ", "b": [{"text": "t [x]"}, ["deep", {"k": {"k": {"k": "deepest"}}}]], "label": "no", "page": {"text": "no"}, "aa": "{not json"}, "n": 4, "x": None, "y": True, "a": "last", "again": "c1"},
        "just text", [], {}, [["a", "b"], "c", "```a```"], 5, deep, {"text": ["no string"], "md": "[1]"},
    ]
    table = spark.createDataFrame([(k, json.dumps(v)) for k, v in enumerate(layouts)] + [(90, "{bad"), (91, None)], "page_id long, json string")
    plain = lambda t: " ".join(t.replace("```", " ").split())
    want = {k: "\n".join(dict.fromkeys(p for t in walked(v) if (p := plain(t)))) for k, v in enumerate(layouts)} | {90: "", 91: ""}
    assert {r.page_id: r.text for r in L.flatten_json(table).collect()} == want
    assert L.flatten_json(table.limit(0)).count() == 0


def request_files(spark, at, parts):
    for k, part in enumerate(parts):
        table = spark.createDataFrame(part, "request_id long, minutes int, provider string, latency_ms double").selectExpr("request_id", "timestamp_seconds(1700000000 + 60 * minutes) AS ts", "provider", "latency_ms")
        table.coalesce(1).write.mode("append").parquet(f"{at}/in")


def test_counters_go_on_after_a_stop(spark, tmp_path):
    first, second = [(1, 0, "a", 10.0), (2, 5, "b", 20.0)], [(3, 200, "a", 30.0), (4, 201, "a", 50.1)]
    at = str(tmp_path)
    request_files(spark, at, [first])
    run = lambda: intake.run_metrics(intake.stream_requests(spark, f"{at}/in"), f"{at}/out", f"{at}/check").awaitTermination()
    run()
    assert {(r.provider, r.requests) for r in intake.latest_metrics(spark, f"{at}/out").collect()} == {("a", 1), ("b", 1)}
    request_files(spark, at, [second])
    run()
    run()
    columns = ["provider", "requests", "avg_latency_ms", "max_latency_ms", "first_at", "last_at"]
    assert rows(intake.latest_metrics(spark, f"{at}/out"), *columns) == rows(intake.provider_metrics(spark.read.parquet(f"{at}/in")), *columns)


def test_windows_are_given_out_once(spark, tmp_path):
    at = str(tmp_path)
    run = lambda: intake.run_window_metrics(intake.stream_requests(spark, f"{at}/in"), f"{at}/out", f"{at}/check").awaitTermination()
    request_files(spark, at, [[(1, 0, "a", 10.0), (2, 5, "a", 20.0)]])
    run()
    request_files(spark, at, [[(3, 10, "a", 60.0), (4, 600, "a", 1.0)]])
    run()
    run()
    done = spark.read.parquet(f"{at}/out")
    assert [(r.requests, r.avg_latency_ms) for r in done.collect()] == [(3, 30.0)]
    whole = intake.window_metrics(spark.read.parquet(f"{at}/in"))
    assert rows(done, "provider", "window_start", "requests") == rows(whole.where("requests = 3"), "provider", "window_start", "requests") and whole.count() == 2


def test_the_whole_run_on_a_stream(spark, corpus, tmp_path):
    _, words, _, _ = corpus
    words = words.where("page_id < 16").select([F.col(c.split()[0]).cast(c.split()[1]) for c in intake.WORDS.split(", ")])
    for part in (0, 1):
        words.where(F.col("page_id") % 2 == part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    plan = lambda w: run_corpus(w, forms.pages(w), field_rules(spark), A.match_anchors(w, anchor_rules(spark)))
    reader = spark.readStream.schema(intake.WORDS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    intake.run_intake(reader, plan, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    columns = ["page_id", "field", "value", "method", "confidence_score"]
    assert rows(spark.read.parquet(f"{tmp_path}/out"), *columns) == rows(plan(words), *columns)


def test_words_keep_their_order_in_csv(spark, corpus, tmp_path):
    _, words, pages, _ = corpus
    shuffled = words.where("page_id = 12").withColumn("word_no", (F.col("word_no") * 7) % 41)
    tables.write_words(shuffled, pages, f"{tmp_path}/w")
    columns = ["page_id", "word_no", "text", "x", "y", "line_num"]
    assert rows(tables.read_words(spark, f"{tmp_path}/w"), *columns) == rows(shuffled, *columns)


def test_the_probe_report_is_ordered(spark, tmp_path):
    probe = spark.createDataFrame([(1, "b", 1, 2), (2, "a", 1, 1), (1, "a", 2, 3), (3, "a", 1, 3)], "page_id long, anchor string, line_num int, token_overlap long")
    tables.write_probe(probe.coalesce(1), f"{tmp_path}/p")
    read = [r for f in sorted((tmp_path / "p").glob("*.csv")) for r in f.read_text().splitlines()[1:]]
    assert read == ["1,a,2,3", "3,a,1,3", "2,a,1,1", "1,b,1,2"]


def test_written_tables_are_deleted(spark, tmp_path):
    table = written(spark.range(3), "kept")
    with scratch(spark):
        inner = written(spark.range(3), "inner")
        assert inner.count() == 3
    assert table.count() == 3
    with pytest.raises(Exception, match="(?i)exist|not.found"):
        spark.read.parquet(inner.written_at).count()
    dropped(table)
    with pytest.raises(Exception, match="(?i)exist|not.found"):
        spark.read.parquet(table.written_at).count()
    written(spark.range(1), "more")
    assert clear_written(spark) >= 1 and clear_written(spark) == 0
