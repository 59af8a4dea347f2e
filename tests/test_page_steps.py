"""Steps that many queries share: words by page, labels that equal an alias."""

import re

import __spark_entry__ as registered
from formfields.operators import anchors as A
from formfields.plans.rules import anchor_rules
from formfields.sources import forms

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_words_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(forms, "PARTITION_PAGES", 100)
    # Orders are dealt out by page before they grow into words; whatever goes by page finds them there.
    queries = registered.queries()
    for name in ("page_extents", "assemble_lines", "scope_words", "exact_anchors", "value_windows"):
        plan = plan_of(queries[name](spark, SF))
        assert re.findall(r"Exchange hashpartitioning\(page_id[^\n]*ENSURE_REQUIREMENTS", plan) == [], name


def test_partitions_grow_with_pages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(forms, "PARTITION_PAGES", 100)
    assert forms.form_words(spark, SF).rdd.getNumPartitions() == 16


def brute_labels(words, rules, max_tokens=4):
    out = {}
    for page in {w["page_id"] for w in words}:
        mine = sorted((w for w in words if w["page_id"] == page), key=lambda w: w["word_no"])
        ext_w, ext_h = max(w["x"] + w["w"] for w in mine), max(w["y"] + w["h"] for w in mine)
        for anchor, aliases, region in rules:
            scope = [w for w in mine if w["text"].strip()]
            if region:
                rx, ry = int(region[0] * ext_w), int(region[1] * ext_h)
                rw, rh = max(1, int(region[2] * ext_w)), max(1, int(region[3] * ext_h))
                scope = [w for w in scope if rx <= w["x"] + w["w"] / 2 <= rx + rw and ry <= w["y"] + w["h"] / 2 <= ry + rh]
            hits = []
            for k, alias in enumerate(aliases):
                tokens = alias.split(" ")
                for i in range(len(scope)):
                    for kind, n in [(0, len(tokens)), (1, 1), (1, 2), (1, 3)]:
                        part = scope[i : i + n]
                        if len(part) < n or len({w["line_num"] for w in part}) > 1 or (kind == 1 and len(tokens) == 1) or (kind == 0 and n > max_tokens):
                            continue
                        texts = [w["text"] for w in part]
                        if texts == tokens if kind == 0 else "".join(texts) == "".join(tokens):
                            hits.append((k, kind, kind * n, i, alias, part))
            if hits:
                best = min(hits, key=lambda h: h[:4])
                part = best[5]
                x, y = min(w["x"] for w in part), min(w["y"] for w in part)
                out[page, anchor] = (best[4], x, y, max(w["x"] + w["w"] for w in part) - x, max(w["y"] + w["h"] for w in part) - y)
    return out


def test_exact_labels_against_brute_force(spark):
    rules = [("a", ["AB CD", "AB", "ABC D EF"], None), ("b", ["CD AB C", "D D", "ABAB"], (0.0, 0.0, 0.5, 1.0)), ("c", ["A B C D E"], (0.2, 0.2, 0.6, 0.6))]
    vocabulary = ["AB", "CD", "C", "D", "ABC", "EF", "ABAB", " ", "A", "BC"]
    words = []
    for page in range(300):
        for k in range(page % 17):
            turn = (page * 31 + k * k * 7 + k * 3) % 1009
            words.append({"page_id": page, "word_no": k, "text": vocabulary[turn % len(vocabulary)], "conf": 90.0, "x": turn * 13 % 900, "y": turn * 7 % 600, "w": 5 + turn % 40, "h": 10, "block_num": 1, "par_num": 1, "line_num": k // 6})
    table = spark.createDataFrame([tuple(w.values()) for w in words], "page_id long, word_no int, text string, conf double, x int, y int, w int, h int, block_num int, par_num int, line_num int")
    anchors = spark.createDataFrame([(k, a, 0.9, aliases, *(r or (None,) * 4)) for k, (a, aliases, r) in enumerate(rules)], "anchor_no int, anchor string, min_score double, aliases array<string>, rx double, ry double, rw double, rh double")
    found = {(r["page_id"], r["anchor"]): (r["alias"], r["ax"], r["ay"], r["aw"], r["ah"]) for r in A.match_anchors(table, anchors, exact=True).collect()}
    wanted = brute_labels(words, rules)
    assert found == wanted
    assert len({(a, v[0]) for (_, a), v in wanted.items()}) >= 5


def test_no_pages_no_labels(spark):
    words = forms.form_words(spark, SF).where("false")
    assert A.match_anchors(words, anchor_rules(spark), exact=True).collect() == []
