"""Cleaning, filters and final forms: hand-worked cases of each rule."""

import pytest
from pyspark.sql import functions as F

from formfields.functions import filters as P
from formfields.functions import text as T
from formfields.operators.brands import nearest_brand
from formfields.operators.fields import score_of
from formfields.plans.rules import BRANDS


def all_of(spark, cases, build):
    """What build makes of each input, in one job."""
    rows = spark.createDataFrame([(k, *c) if isinstance(c, tuple) else (k, c) for k, c in enumerate(cases)])
    names = [F.col(c) for c in rows.columns[1:]]
    return [r.v for r in rows.select(F.col(rows.columns[0]).alias("k"), build(*names).alias("v")).orderBy("k").collect()]


def test_cleaning(spark):
    assert all_of(spark, ["MOTOR SANAYI LTD", "SOYADI ADI YILMAZ A", "ŞAHİN/NOTER"], T.clean_owner) == ["MOTOR SANAYI LTD", "YILMAZ", "SAHIN/"]
    assert all_of(spark, ["TIPI C4X", "YENI SYMBOL AUTH.1.5 DCI65", "A B C D E F", "MODEL"], T.clean_type) == ["C4X", "AUTH.1.5 DCI65", "A B C D", ""]
    assert all_of(spark, ["AB-123 LONGWORD", "ABC-DEF", "12-34-56 7"], T.clean_alnum) == ["AB123", "ABCDEF", "123456"]
    assert all_of(spark, ["AB-123 LONGWORD"], T.alnum_token) == ["AB-123"]
    assert all_of(spark, ["1 . 2 . 24", "x 3-4-1999 y", "none"], T.clean_date) == ["01/02/2024", "03/04/1999", ""]


def test_scores(spark):
    cases = [("owner_text", "ALI VELI"), ("owner_text", "SOYADI ALI"), ("owner_text", "NOTER"), ("text_upper", "AB C3D4 EFGHIJ"), ("vehicle_type", "YENI C4X"), ("alnum_hyphen_upper", "AB-12"), ("digits", "12345"), ("date", "01/02/2024"), ("plate", "34AB123"), ("keep", None)]
    assert all_of(spark, cases, score_of) == [7, 0, 0, 10, 15, 12, 5, 100, 19, 0]


def test_post_clean(spark):
    rows = spark.createDataFrame([(0, "TIPI: C4X", ["TIPI"], 2, True), (1, "AB", [], 3, False), (2, "JT8", [], 2, True), (3, "12345", [], 2, True), (4, "MOTOR NO MOTORNO X12345", ["MOTOR NO", "MOTORNO"], 0, False), (5, None, [], 0, False)], "k int, v string, p array<string>, n int, m boolean")
    assert [r.o for r in rows.orderBy("k").select(P.post_clean(F.col("v"), F.col("p"), F.col("n"), F.col("m")).alias("o")).collect()] == ["C4X", None, "JT8", None, "X12345", None]


def test_field_filters(spark):
    cases = {
        ("plate", "34 ab 123"): "34AB123", ("plate", "12345"): None, ("serial_no", "BC NO 881203"): "881203", ("serial_no", "BELGE SERI"): None, ("serial_no", "12 345"): None,
        ("owner_surname", "YILMAZ KAYA DEMIR"): "YILMAZ KAYA", ("owner_surname", "TESCIL TARIHI"): None, ("owner_surname", "OZ TURIZM SANAYI LTD SIRKETI ADRESI X MAH"): "OZ TURIZM SANAYI LTD SIRKETI", ("owner_surname", "AB"): None,
        ("owner_name", "ALI LTD"): None, ("owner_name", "ALI CAN VELI HAN"): "ALI CAN VELI", ("type", "OTOMOBIL"): None, ("type", "D.4 CLIO15 2012 BEYAZ"): "CLIO15", ("type", "YENI SYMBOL"): "YENI SYMBOL",
        ("engine_no", "K9KO1IO2"): "K9K01102", ("engine_no", "AB12"): None, ("chassis_no", "VF1LIOQ0000000000"): "VF1L1000000000000", ("chassis_no", "VF1L12345"): None, ("tax_or_id_no", "123 456 7890"): "1234567890", ("tax_or_id_no", "123"): None,
        ("inspection_date", "01/02/2030"): "01/02/2030", ("inspection_date", "01/02/1949"): None, ("inspection_date", "41/02/2000"): None, ("model_year", "2001"): "2001", ("brand", "MARKA"): None, ("plate", None): None,
    }
    found = all_of(spark, list(cases), P.field_filter)
    assert dict(zip(cases, found, strict=True)) == cases


def test_final_forms(spark):
    cases = {
        ("plate", "O6 ABC I23"): "O6ABCI23", ("plate", "O6ABC123"): "06ABC123", ("chassis_no", "VO1Q000000000000I"): "V01Q0000000000001".replace("Q", "0"), ("chassis_no", "VQI45678901234567"): "VQI45678901234567", ("chassis_no", "SHORT"): None, ("chassis_no", "VF1234567890123456"): "VF123456789012345",
        ("engine_no", "OIOOI1"): "OIO011", ("model_year", "YIL 1999"): "1999", ("model_year", "1949"): None, ("tax_or_id_no", "123 456 7890"): "1234567890", ("tax_or_id_no", "x12345678901 99"): "12345678901", ("serial_no", "BC 1234 NO 881203"): "881203", ("serial_no", "123"): None,
        ("inspection_date", "31/02/2020"): "31/02/2020", ("inspection_date", "31/13/2020"): None, ("inspection_date", "1.2.24"): "01/02/2024", ("brand", "B1"): None, ("brand", "fiat"): "FIAT", ("type", " C4 "): "C4",
    }
    found = all_of(spark, list(cases), T.validated)
    assert dict(zip(cases, found, strict=True)) == cases


def test_vin_in_context(spark):
    assert all_of(spark, ["VE1L8N00000000000", "VFIT5V00000000000", "SHORT", "VEI88N00000000000"], T.vin_in_context) == ["VF1LBN00000000000", "VF1TSV00000000000", None, "VF188N00000000000"]


def test_whitelist_and_display(spark):
    assert all_of(spark, [("A1-B2", "0123456789"), ("A1", None), ("", "A")], T.only_allowed) == ["12", "A1", ""]
    assert all_of(spark, ["GRI ESKISEHIR GRISI"], T.shown) == ["GRİ ESKİŞEHİR GRISI"]


def test_brands():
    assert [nearest_brand(k, BRANDS) for k in ("FIAT", "FIAI", "MERCEDESBENZ", "HYUNDAI1", "QQQQ", "REN", "FORI")] == ["FIAT", "FIAT", "MERCEDES-BENZ", "HYUNDAI", None, None, "FORD"]


@pytest.mark.parametrize("word", ["TICARI", "LTD"])
def test_company_words_are_no_names(spark, word):
    assert all_of(spark, [f"ALI {word}"], P.given_name) == [None]
