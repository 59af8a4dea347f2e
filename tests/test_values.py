"""Strategies, field filters and words of text lines, pinned by hand and against their SQL."""

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from formfields import entries
from formfields.functions.filters import field_filter
from formfields.functions.text import STRATEGIES, clean_text, null_if_blank
from formfields.value_oracles import DOC_WORDS

LINES = {
    1: "PLAKA 34 abc 123 (şase)", 2: "01.2.24 ve 3-4-2020", 3: "", 4: "- --", 5: "SOYADI YILMAZ A ADI AYŞE", 6: "TIPI CLIO 1.5DCI 90 K9K", 7: "AB-12 1234-567 xy", 8: "  a   b\tc ",
}
EXPECTED = {
    "plate": {1: "34ABC123", 3: None, 4: None, 7: "AB121234567XY"}, "digits": {1: "123", 2: "2020", 4: None, 7: "1234"}, "date": {2: "01/02/2024", 1: None},
    "alnum_hyphen_upper": {7: "AB-12", 1: "PLAKA", 4: None}, "alnum_upper": {7: "AB12"}, "text_upper": {1: "PLAKA 34 ABC 123 SASE", 8: "A B C", 3: None},
    "owner_text": {5: "YILMAZ AYSE"}, "vehicle_type": {6: "1.5DCI K9K"}, "keep": {8: "a b c", 3: None},
}
FILTERED = [
    ("plate", "34 ABC 123", "34ABC123"), ("plate", "3 AB", None), ("brand", "MARKASI", None), ("brand", "RENAULT", "RENAULT"), ("serial_no", "AB 12345 NUMARA 678901", "678901"),
    ("owner_surname", "YILMAZ ADRESI MERKEZ 12", "YILMAZ"), ("owner_surname", "ACME LIMITED SIRKETI NOTER", "ACME LIMITED SIRKETI"), ("owner_surname", "TESCIL TARIHI", None),
    ("owner_name", "AYSE X NUR", "AYSE NUR"), ("owner_name", "ACME LTD", None), ("type", "OTOMOBIL", None), ("type", "CLIO 2010 D4 SPORT", "CLIO SPORT"),
    ("chassis_no", "OQ1ABCDEFGHIO123", "001ABCDEFGH10123"), ("chassis_no", "ABC1234", None), ("tax_or_id_no", "NO 1234567890", "1234567890"), ("inspection_date", "31/12/1949", None), ("inspection_date", "31/12/1950", "31/12/1950"),
]


def test_strategies_of_lines(spark):
    lines = spark.createDataFrame(list(LINES.items()), "k int, text string")
    got = {r["k"]: r for r in lines.select("k", *[null_if_blank(clean(F.col("text"))).alias(n) for n, clean in STRATEGIES.items()]).collect()}
    for strategy, wanted in EXPECTED.items():
        for k, value in wanted.items():
            assert got[k][strategy] == value, (strategy, k)


def test_filters_of_fields(spark):
    rows = spark.createDataFrame(FILTERED, "field string, text string, wanted string")
    got = rows.select("field", "text", "wanted", field_filter(F.col("field"), clean_text(F.col("text"))).alias("got")).collect()
    assert [(r.field, r.text, r.got) for r in got] == [(r.field, r.text, r.wanted) for r in got]


def test_words_of_lines_by_sql(spark, tmp_path):
    texts = ["one two  three\nfour", " lead\ttab  x\n\nş ğü tail ", None, "", "a" * 40 + " b c", " ".join(["w" * (k % 7 + 1) for k in range(500)])]
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    spark.createDataFrame(list(zip(range(len(texts)), texts, strict=True)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = entries.q_doc_words(spark, str(tmp_path)).toPandas()
    with duckdb.connect() as held:
        held.register("documents", documents)
        wanted = held.execute(DOC_WORDS).df()
    keys, columns = ["page_id", "word_no"], sorted(got.columns)
    assert columns == sorted(wanted.columns)
    left, right = (df[columns].sort_values(keys).reset_index(drop=True).astype({c: "float64" for c in columns if c != "text"}) for df in (got, wanted))
    pd.testing.assert_frame_equal(left, right)
