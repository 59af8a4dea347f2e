"""Steps that findings of round 4 named, held against the plain form of each."""

import difflib
import re

import pytest
from pyspark.sql import functions as F

from formfields import entries
from formfields.operators import anchors as A
from formfields.operators import fields as V
from formfields.operators import page_rows as P
from formfields.operators import words as W
from formfields.operators.candidates import region_words
from formfields.plans.rules import anchor_rules, field_rules
from formfields.sources import forms

WORDS = "page_id long, word_no int, text string, conf double, x int, y int, w int, h int, block_num int, par_num int, line_num int"
RULES = "anchor_no int, anchor string, min_score double, aliases array<string>, rx double, ry double, rw double, rh double"


def orders(spark, path, n=40):
    spark.range(n).selectExpr("id AS o_orderkey", "id * 3 AS o_custkey", "date_add(DATE'1995-01-01', CAST(id * 17 AS int)) AS o_orderdate").write.parquet(f"{path}/orders.parquet")
    return str(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["match_anchors", "best_lines", "best_lines_exact", "roi_lines", "region_text"])
def test_pages_are_read_where_they_lie(spark, tmp_path, name):
    """Words are made once and no array of a page's words is built; before, they were made twice or joined with regions word by word."""
    shown = plan(entries.queries()[name](spark, orders(spark, tmp_path)))
    assert len(re.findall(r"Generate posexplode\w*\(words", shown)) == 1 and "collect_list" not in shown and "MapInArrow" in shown


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size", [1, 50, 1 << 17])
def test_lines_and_texts_of_pages_are_those_word_by_word(spark, tmp_path, monkeypatch, size):
    """Batches of any size hold whole pages, and a page without words has its regions."""
    monkeypatch.setattr(W, "BATCH_WORDS", size)
    at = orders(spark, tmp_path, 23)
    words, pages, rules = forms.form_words(spark, at).where("page_id <> 7").cache(), forms.form_pages(spark, at), field_rules(spark)
    labels = A.match_anchors(words, anchor_rules(spark)).cache()
    rois = V.resolve_rois(pages, rules, labels)
    found = lambda *wanted: P.found_regions(words, pages, anchor_rules(spark), rules.drop("prefer_anchor"), *wanted)
    box = lambda c: [F.col(f"{c}.{k}") for k in ("text", *"xywh")]
    assert rows(found("within").select("page_id", "field", *box("within"))) == rows(V.best_roi_lines(words, rois).select("page_id", "field", "raw", *"xywh"))
    beside = V.best_lines(words, V.value_windows(pages, rules, labels)).select("page_id", "field", "raw", *"xywh")
    assert rows(found("beside").select("page_id", "field", *box("beside"))) == rows(beside) and beside.count() > 200
    assert rows(found("inside").select("page_id", "field", "inside.text")) == rows(region_words(words, rois).select("page_id", "field", "text"))
    every = found().cache()
    assert every.count() == 23 * 13 and every.where("page_id = 7 AND roi IS NOT NULL").count() == rules.where("fx IS NOT NULL").count()
    table = P.page_table(words, pages, labels)
    assert rows(P.table_words(table).select(words.columns)) == rows(words) and table.where("ws IS NULL").count() == 1


def edits(a, b):
    return len(b) if not a else len(a) if not b else min(edits(a[1:], b) + 1, edits(a, b[1:]) + 1, edits(a[1:], b[1:]) + (a[0] != b[0]))


def plain_similarity(p, q):
    longest = max(len(p), len(q))
    share = 1 - edits(p, q) / longest if abs(len(p) - len(q)) <= (2 if longest <= 4 else 3) else 0.0
    return max(difflib.SequenceMatcher(None, p, q).ratio(), share)


def test_similar_labels_against_brute_force(spark):
    aliases = [["AB CD", "ABCE", "AD BC A"], ["CD", "BB AA"]]
    least = [0.6, 0.75]
    vocabulary = ["AB", "CE", "C", "D0", "ABE", "BBA", "ACD", "A", "BAC", "DD"]
    words = [(p, k, vocabulary[(p * 31 + k * k * 7 + k * 3) % 1009 % 10], 90.0, 10 * k, p, 8, 10, 1, 1, k // 4) for p in range(150) for k in range(p % 9)]
    wanted = {}
    for page in range(150):
        mine = [w for w in words if w[0] == page]
        for a, (names, bound) in enumerate(zip(aliases, least, strict=True)):
            found = []
            for no, alias in enumerate(names):
                tokens = alias.split(" ")
                for kind, n in [(0, len(tokens)), *([(1, n) for n in (1, 2, 3)] if len(tokens) > 1 else [])]:
                    for i in range(len(mine) - n + 1):
                        part = [w[2] for w in mine[i : i + n]]
                        if len({w[10] for w in mine[i : i + n]}) > 1 or (kind and abs(len("".join(part)) - len("".join(tokens))) > 2):
                            continue
                        pairs = [("".join(part), "".join(tokens))] if kind else list(zip(part, tokens, strict=True))
                        score = sum(plain_similarity(*p) for p in pairs) / len(pairs)
                        if score >= bound:
                            # A phrase that equals an alias comes before all that are like one.
                            found.append((-score, no, kind, kind * n, i, alias, mine[i][4], mine[i + n - 1][4] + 8 - mine[i][4]))
            if found:
                best = min(found)
                wanted[page, f"a{a}"] = (best[5], round(-best[0], 9), best[6], best[7])
    rules = spark.createDataFrame([(k, f"a{k}", s, names, None, None, None, None) for k, (names, s) in enumerate(zip(aliases, least, strict=True))], RULES)
    found = A.match_anchors(spark.createDataFrame(words, WORDS), rules).collect()
    assert {(r.page_id, r.anchor): (r.alias, round(r.score, 9), r.ax, r.aw) for r in found} == wanted
    assert sum(v[1] < 1 for v in wanted.values()) > 50


RUNS = ["PLAKA", "ADI", "NO", "A", "AB", "ABC", "34ABC123", "CLIO15", "GOLF7", "1999", "123456", "12345678901", "D4", "D12", "LTD", "UR", "ADRES", "MAH", "TESCIL", "OTOMOBIL", "VF1A0O0I00Q00123", "VF1AOQI123456", "AOQI12", "KOQI123O", "NOTER", "TIPI", "YIL", "S", "M1"]
TEXTS = ["12/03/2001", "31/13/2020", "34 ABC 123", "AYSE FATMA", "LTD SIRKETI", "Şase No 12", "MAH. X", "D.4 C4X", "BELGE SERI 12345", "", " ", None, "A-B", "AB12\n", "ÇELİK"]


def test_values_of_one_run_are_those_of_any_text(spark):
    """Runs of capitals and digits have a shorter way through cleaning, prefixes, filters and scores; it gives the same."""
    from formfields.functions import filters, text
    from formfields.plans.rules import FIELD_ORDER

    value, field, strategy = F.col("value"), F.col("field"), F.col("strategy")
    one = spark.createDataFrame([(v,) for v in RUNS + TEXTS], "value string")
    filtered = one.crossJoin(spark.createDataFrame([(f,) for f in [*FIELD_ORDER, "other"]], "field string"))
    got = filtered.select("value", "field", filters.field_filter(field, value).alias("v"))
    assert rows(got) == rows(filtered.select("value", "field", filters.filtered_text(field, value).alias("v")))
    assert got.where("v IS NOT NULL").count() > 150
    names = one.crossJoin(spark.createDataFrame([(s,) for s in [*text.STRATEGIES, "other"]], "strategy string"))
    plain = text.collapsed(value)
    for name, build in text.STRATEGIES.items():
        plain = F.when(strategy == name, build(value)).otherwise(plain)
    assert rows(names.select("value", "strategy", text.cleaned(strategy, value).alias("v"))) == rows(names.select("value", "strategy", text.null_if_blank(plain).alias("v")))
    # A blank at its end makes a text no run, and changes no score of words.
    scored = [names.select("value", "strategy", V.score_of(strategy, v).alias("v")).where("strategy IN ('text_upper', 'owner_text', 'vehicle_type') AND value IS NOT NULL") for v in (value, F.concat(value, F.lit(" ")))]
    assert rows(scored[0]) == rows(scored[1])


def test_rule_effects_find_lines_once(spark, tmp_path):
    """Lines are written before they are cleaned; before, brands and candidates made all words again."""
    made = []
    real = entries.lines_beside
    try:
        entries.lines_beside = lambda *a, **k: made.append(plan(real(*a, **k))) or real(*a, **k)
        shown = plan(entries.q_rule_effects(spark, orders(spark, tmp_path)))
    finally:
        entries.lines_beside = real
    assert len(made) == 1 and "posexplode" not in shown


def test_a_text_is_cleaned_once_for_a_field(spark, tmp_path):
    at = orders(spark, tmp_path)
    words, labels = entries.found(spark, at, exact=True)
    table = P.page_table(words, forms.form_pages(spark, at), labels).cache()
    read = P.page_readings(table, field_rules(spark)).where("raw IS NOT NULL").cache()
    assert read.count() == read.select("page_id", "field", "raw").distinct().count() and read.where("size(cells) > 1").count() > 200


def test_texts_of_lines_are_those_of_assembled_lines(spark, tmp_path):
    cells = [(1, 0, "AB", 50, 3), (1, 1, "CD", 10, 3), (1, 2, " ", 5, 3), (1, 3, "EF", 10, None), (2, 0, None, 1, 1), (2, 1, "x y", 9, 1), (2, 2, "z", 9, 1), (3, 0, " ", 1, 1)]
    words = spark.createDataFrame([(p, k, t, 90.0, x, 5, 8, 10, 1, 1, line) for p, k, t, x, line in cells], WORDS)
    lines = ["page_id", "block_num", "par_num", "line_num", "text"]
    assert rows(W.line_texts(words).select(lines)) == rows(W.assemble_lines(words).select(lines)) == [(1, 1, 1, 3, "CD AB"), (1, 1, 1, None, "EF"), (2, 1, 1, 1, "x y z")]
    for query in (entries.q_field_filters, entries.q_standard_values):
        assert "collect_list" not in plan(query(spark, orders(spark, tmp_path / query.__name__)))


@pytest.mark.parametrize("name", ["payload_words", "exemplars"])
def test_words_are_made_once(spark, tmp_path, name):
    """Payloads were read once for words of their own and once for boxes; words once for their extents and once for themselves."""
    shown = plan(entries.queries()[name](spark, orders(spark, tmp_path)))
    assert len(re.findall(r"Generate posexplode\w*\((?:rec_texts|words)", shown)) == 1
