"""Steps that findings of round 3 named, held against the plain form of each."""

import re

from pyspark.sql import functions as F

from formfields.functions import text as X

ODD = ["PLAKA", "34ABC123", "34 ABC 123", "A 34 AB 12 B", "", " ", None, "ADI", "SOYADI X", "TIPI", "12/3/99", "1.2.2020 ve 03-04-2021", "a\tb", "A\n", "x  y", "Şase No: 12-A", "K9K-77", "7", "12 345 6", "ÇELİK", "A", "M0T0R N0", "é-1", " A B"]


def test_values_of_all_strategies_in_one_go_are_those_of_each_strategy(spark):
    rows = spark.createDataFrame(list(enumerate(ODD)), "line_num int, text string")
    wanted = rows.select("line_num", *[X.null_if_blank(build(F.col("text"))).alias(name) for name, build in X.STRATEGIES.items()]).orderBy("line_num").collect()
    assert X.standard_values(rows, "line_num").orderBy("line_num").collect() == wanted
    assert [r.plate for r in wanted[1:4]] == ["34ABC123", "34ABC123", "34AB12"]
    assert [r.digits for r in wanted[17:19]] == ["7", "345"]


def orders(spark, path, n=40):
    spark.range(n).selectExpr("id AS o_orderkey", "id * 3 AS o_custkey", "date_add(DATE'1995-01-01', CAST(id * 17 AS int)) AS o_orderdate").write.parquet(f"{path}/orders.parquet")
    return str(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_second_pass_makes_words_twice_whatever_its_fields(spark, tmp_path):
    """Once for the hits of all fields, once for the labels; before, plates and chassis numbers made them again."""
    from formfields import entries

    assert len(re.findall(r"Generate posexplode\w*\(words", plan(entries.q_second_pass(spark, orders(spark, tmp_path))))) == 2


def test_second_pass_runs_words_together(spark):
    from formfields.operators import second_pass as S

    cells = [("34", 100, 120, 1), ("AB", 140, 120, 1), ("123", 180, 120, 1), ("VF1A00000", 100, 600, 2), ("00000123", 250, 605, 3), ("VF1B0000000000124", 1200, 700, 4)]
    words = spark.createDataFrame([(1, k, t, 90.0, x, y, 30, 20, 1, 1, line) for k, (t, x, y, line) in enumerate(cells)], "page_id long, word_no int, text string, conf double, x int, y int, w int, h int, block_num int, par_num int, line_num int")
    pages = spark.createDataFrame([(1, 1600, 1000)], "page_id long, doc_w int, doc_h int")
    found = S.second_pass_candidates(words, pages, ["plate", "chassis_no"]).select("field", "pass", "value", "raw", "x", "y", "w", "h", F.round("score", 2).alias("score")).collect()
    assert sorted(map(tuple, found)) == [
        ("chassis_no", 0, "VF1B0000000000124", "VF1B0000000000124", 1200, 700, 30, 20, 0.62), ("chassis_no", 1, "VF1A0000000000123", "VF1A0000000000123", 100, 600, 180, 25, 0.87), ("plate", 0, "34AB123", "34 AB 123", 100, 120, 110, 20, 0.54),
    ]


def test_lines_beside_labels_are_found_without_copying_words(spark, tmp_path):
    """No word meets the windows of its page in a join; effects of rules read lines that are cleaned and written once."""
    from formfields import entries

    for query in (entries.q_best_lines_exact, entries.q_rule_effects):
        shown = plan(query(spark, orders(spark, tmp_path / query.__name__)))
        assert "rank_score" not in shown
