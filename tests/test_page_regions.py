"""Regions and lines of pages as rows, column by column: against the form word by word, and without copies of a page's words."""

from difflib import SequenceMatcher

from pyspark.sql import functions as F

from formfields.operators import anchors as A
from formfields.operators import fields as V
from formfields.operators import page_rows as P
from formfields.plans.rules import field_rules

WORDS = "page_id long, word_no int, text string, conf double, x int, y int, w int, h int, block_num int, par_num int, line_num int"


def pages_of(spark):
    texts = ["AB12", "x", " ", "Straße 7", "34 ABC", "ığüş", "", "MODEL", "1999", "--"]
    words, labels = [], []
    for page in range(120):
        for k in range(page % 23):
            turn = (page * 37 + k * k * 11 + k * 5) % 997
            words.append((page, k, texts[turn % len(texts)], float(turn % 90), turn * 13 % 1500, turn * 29 % 950, 5 + turn % 90, 24, 1, 1 + turn % 2, k // 4))
        labels += [(page, r["anchor"], page * 17 % 1200, page * 41 % 800, 40 + page, 24) for k, r in enumerate(field_rules(spark).select("anchor").distinct().sort("anchor").collect()) if (page + k) % 3]
    pages = spark.range(120).select(F.col("id").alias("page_id"), F.lit(1600).alias("doc_w"), F.lit(1000).alias("doc_h"))
    return spark.createDataFrame(words, WORDS), pages, spark.createDataFrame(labels, "page_id long, anchor string, ax int, ay int, aw int, ah int")


def test_lines_of_regions_word_by_word(spark):
    words, pages, labels = pages_of(spark)
    rules = field_rules(spark)
    regions = P.region_table(P.page_table(words, pages, labels), rules).cache()
    assert regions.count() == 120 * rules.count()
    rois, windows = V.resolve_rois(pages, rules, labels), V.value_windows(pages, rules, labels)
    rows = lambda df, box: {tuple(r) for r in df.where(f"{box} IS NOT NULL").select("page_id", "field", *[f"{box}.{c}" for c in "xywh"]).collect()}
    assert rows(regions, "roi") == {tuple(r) for r in rois.collect()}
    assert rows(regions, "window") == {tuple(r) for r in windows.select("page_id", "field", "rx", "ry", "rw", "rh").collect()}
    lines = lambda name: {tuple(r) for r in regions.where(f"{name} IS NOT NULL").select("page_id", "field", *[f"{name}.{c}" for c in ("text", *"xywh")]).collect()}
    beside = {tuple(r) for r in V.best_lines(words, windows).select("page_id", "field", "raw", *"xywh").collect()}
    within = {tuple(r) for r in V.best_roi_lines(words, rois).select("page_id", "field", "raw", *"xywh").collect()}
    assert lines("beside") == beside and lines("within") == within
    assert len(beside) > 30 and len(within) > 30
    regions.unpersist()


def test_words_are_not_copied_for_each_rule(spark):
    plan = P.region_table(P.page_table(*pages_of(spark)), field_rules(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def test_words_that_differ_in_digits_are_rated_once(spark, monkeypatch):
    seen = []
    rated = A.rated_pairs
    monkeypatch.setattr(A, "rated_pairs", lambda pairs: seen.append(pairs.select("p", "q").distinct().count()) or rated(pairs))
    rules = spark.createDataFrame([(0, "engine", 0.7, ["MOTOR NO", "MOTORNO"], None, None, None, None)], "anchor_no int, anchor string, min_score double, aliases array<string>, rx double, ry double, rw double, rh double")
    words = spark.createDataFrame([(k, 0, f"MOT{k:05d}", 90.0, 0, 0, 50, 24, 1, 1, 0) for k in range(300)], WORDS)
    found = A.anchor_debug(words, rules).collect()
    ratio = max(SequenceMatcher(None, "MOT00000", t).ratio() for t in ("MOTOR", "MOTORNO"))
    assert len(found) == 300 and {(r.best_alias, r.best_alias_token_score) for r in found} == {("MOTOR NO", round(ratio, 4))}
    assert sum(seen) <= 3
