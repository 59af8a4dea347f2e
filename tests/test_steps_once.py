"""Steps whose rows are made once and follow their page: patterns over pages, words of documents, choices with crops."""

import random
import re

from pyspark.sql import functions as F

from formfields import entries
from formfields.operators import anchors as A
from formfields.operators import candidates as C
from formfields.operators import words as W

WORD = "page_id long, word_no int, text string, norm string, conf double, x int, y int, w int, h int, block_num int, par_num int, line_num int"


def orders(spark, path, n=40):
    spark.range(n).selectExpr("id AS o_orderkey", "id * 3 AS o_custkey", "date_add(DATE'1995-01-01', CAST(id * 17 AS int)) AS o_orderdate").write.parquet(f"{path}/orders.parquet")
    return str(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_page_patterns_make_words_once(spark, tmp_path):
    """Before, words were made for the labels and again for the text, and both were joined."""
    shown = plan(entries.q_page_regex(spark, orders(spark, tmp_path)))
    assert len(re.findall(r"Generate posexplode\w*\(words", shown)) == 1 and "LeftAnti" not in shown


def test_texts_of_pages_as_rows_are_those_of_words_as_rows(spark):
    """Blank and null words, lines of several blocks at one place, words at one x, places below zero."""
    rng = random.Random(5)
    word = lambda p, k: (p, k, rng.choice(["A", "ş1", "İ", " ", "", "34 AB", "ОІ", "/", "z"]), None, 90.0, rng.randrange(-2, 3) * 10, rng.randrange(-1, 3) * 10, 5, 5, rng.randrange(2), rng.choice([1, None]), rng.choice([1, 2, 3]))
    rows = [word(p, k) for p in range(40) for k in range(rng.randrange(1, 30))] + [(99, 0, " ", None, 1.0, 0, 0, 1, 1, 1, 1, 1), (98, 0, None, None, 1.0, 0, 0, 1, 1, 1, 1, 1)]
    words = spark.createDataFrame(rows, WORD)
    wanted = {r.page_id: r.text for r in W.page_text(W.assemble_lines(words)).collect()}
    got = {r.page_id: r.text for r in A.page_rows(words, texts=True).select("page_id", W.page_texts(F.col("ws")).alias("text")).collect()}
    assert {p: t for p, t in got.items() if p not in (98, 99)} == wanted and got[98] == got[99] == ""


def test_patterns_of_fields_without_a_label(spark):
    pages = spark.createDataFrame([(1, "34 ABC 12\n1.2.99 03-04-2021 1.2.1999\n2001 1999", ["plate_label"]), (2, "34 ABC 12\n01/02/2003", []), (3, "", [])], "page_id long, text string, found array<string>")
    rules = spark.createDataFrame([("plate", "plate_label"), ("model_year", "year_label"), ("first_registration_date", "date_label"), ("registration_date", None), ("brand", "brand_label")], "field string, anchor string")
    got = sorted((r.page_id, r.field, r.raw) for r in C.page_regex_candidates(pages, rules).collect())
    assert got == [(1, "first_registration_date", "03/04/2021"), (1, "model_year", "1999"), (1, "registration_date", "01/02/1999"), (2, "first_registration_date", "01/02/2003"), (2, "model_year", "2003"), (2, "plate", "34 ABC 12")]
    both = spark.createDataFrame([("a", "plate", "plate_label"), ("b", "plate", "other")], "rule_set string, field string, anchor string")
    assert sorted((r.page_id.rule_set, r.page_id.page_id) for r in C.page_regex_candidates(pages, both).collect()) == [("a", 2), ("b", 1), ("b", 2)]


def test_words_of_a_long_line_are_placed_in_linear_time(spark):
    """The starts of 60,000 words follow the rule that shares the width left by the characters left; before, an array was copied for each word."""
    import time

    rng = random.Random(3)
    parts = ["x" * rng.randrange(1, 9) for _ in range(60_000)]
    lines = lambda n: spark.createDataFrame([(1, 0, " ".join(parts[:n]), 3, 7 * n, 1.0)], "page_id long, line_no int, text string, x int, w int, conf double").withColumn("y", F.lit(1)).withColumn("h", F.lit(2))
    W.lines_to_words(lines(10)).collect()
    for n in (2, 32, 33, 34, 65, 60_000):
        began = time.time()
        got = [(r.x, r.w) for r in W.lines_to_words(lines(n)).orderBy("word_no").collect()]
        took = time.time() - began
        at, left, wanted = 3, sum(map(len, parts[:n])), []
        for k, p in enumerate(parts[:n]):
            width = max(1, round((3 + 7 * n - at) * len(p) / left)) if k < n - 1 else max(1, 3 + 7 * n - at)
            wanted.append((at, width))
            at, left = at + width, left - len(p)
        assert got == wanted
    assert took < 8


def test_texts_are_dealt_out_before_they_grow_into_words(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(entries, "DOC_BYTES", 8)
    spark.createDataFrame([(k, f"a b\nc {k}") for k in range(9)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    shown = plan(entries.q_doc_words(spark, str(tmp_path)))
    assert shown.count("Exchange hashpartitioning") == 1 and shown.index("Window") < shown.index("posexplode") < shown.index("Exchange hashpartitioning")


def test_fields_that_the_gate_leaves_are_not_joined_again(spark, tmp_path):
    """Before, the first choice was joined with itself for the regions and once more for the fields that stay."""
    shown = plan(entries.q_crop_choice(spark, orders(spark, tmp_path)))
    assert "LeftAnti" not in shown and shown.count("LeftSemi") == 1


def test_fields_without_a_rule_stay(spark):
    from formfields.operators import extraction as X
    from formfields.operators.fields import crop_gate

    first = spark.createDataFrame([(1, "brand", None, 0), (1, "odd", None, 0)], "page_id long, field string, value string, confidence_score int").withColumn("roi", F.struct(F.lit(1).alias("x")))
    rules = spark.createDataFrame([("brand", 3)], "field string, threshold int")
    for mode, wanted in (("disabled", set()), ("fallback", {"brand"}), ("always", {"brand"})):
        rows = crop_gate(first, rules, mode).collect()
        assert len(rows) == 2 and {r.field for r in rows if r.asked} == wanted
    assert X.crop_gate is crop_gate
