"""Rule tables: anchors (labels to look for) and fields (where a label's value lies and how to read it)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The rule set of record. anchor, least score, aliases, search region (x, y, w, h as shares of the words' extents).
ANCHORS = [
    ("plate_label", 0.55, ["PLAKA"], (0.0, 0.05, 0.45, 0.45)),
    ("brand_label", 0.5, ["MARKASI"], (0.0, 0.2, 0.5, 0.35)),
    ("type_label", 0.65, ["TIPI"], (0.18, 0.2, 0.45, 0.35)),
    ("model_year_label", 0.45, ["MODEL YILI", "MODELYILI"], (0.2, 0.25, 0.4, 0.45)),
    ("engine_no_label", 0.5, ["MOTOR NO", "MOTORNO", "M0T0R NO", "M0T0RNO", "M0T0RN0", "MOTOR N0", "PSMOTORNO", "PS MOTORNO", "P5MOTORNO", "P5 MOTORNO", "SMOTORNO", "S MOTORNO"], (0.0, 0.32, 0.52, 0.28)),
    ("chassis_no_label", 0.7, ["SASE NO", "ŞASE NO", "ESASENO", "SASENO", "ŞASENO"], (0.0, 0.5, 0.5, 0.3)),
    ("tax_no_label", 0.5, ["VERGI NO", "VERGINO"], (0.5, 0.0, 0.5, 0.25)),
    ("surname_label", 0.6, ["SOYADI", "SOYADI TICARI UNVANI"], (0.5, 0.05, 0.5, 0.3)),
    ("name_label", 0.7, ["ADI"], (0.5, 0.12, 0.5, 0.35)),
    ("first_registration_label", 0.5, ["ILK TESCIL TARIHI", "ILK TESCIL", "ILK TESCIL TAR", "ILKTESCIL", "ILK TESC1L", "ILKTESCILTARIHI"], (0.18, 0.08, 0.4, 0.22)),
    ("registration_label", 0.55, ["TESCIL TARIHI", "TESCIL TAR", "TESCILTARIHI"], (0.18, 0.14, 0.45, 0.22)),
    ("inspection_label", 0.45, ["DIGER BILGILER", "MUA GEC TRH", "MUAYENE"], (0.5, 0.55, 0.5, 0.35)),
    ("serial_label", 0.45, ["BELGE SERI", "SERI"], (0.52, 0.78, 0.45, 0.2)),
]
# field, anchor, offset of its region from the anchor, fallback region, direction, margins (left, top, right, bottom), forced method, strategy, threshold.
FIELDS = [
    ("plate", "plate_label", (0.0, 0.035, 0.19, 0.075), (0.06, 0.165, 0.22, 0.08), "below", (0.01, 0.006, 0.14, 0.07), "anchor_below_line", "plate", 25),
    ("chassis_no", "chassis_no_label", (0.0, 0.03, 0.22, 0.058), None, "below", (0.01, 0.004, 0.16, 0.044), "anchor_below_line", "alnum_upper", 0),
    ("engine_no", "engine_no_label", (0.0, 0.03, 0.22, 0.058), (0.08, 0.44, 0.30, 0.065), "below", (0.01, 0.004, 0.20, 0.052), "anchor_below_line", "alnum_upper", 12),
    ("tax_or_id_no", "tax_no_label", (0.15, -0.008, 0.22, 0.065), (0.67, 0.09, 0.24, 0.08), "right", (0.004, 0.004, 0.21, 0.045), "anchor_right_line", "digits", 9),
    ("brand", "brand_label", (0.0, 0.03, 0.22, 0.07), (0.06, 0.34, 0.25, 0.08), "below", (0.01, 0.004, 0.12, 0.045), "anchor_below_line", "text_upper", 4),
    ("type", "type_label", (0.0, 0.03, 0.12, 0.07), (0.32, 0.34, 0.12, 0.08), "right", (0.006, 0.002, 0.12, 0.04), "anchor_right_line", "vehicle_type", 8),
    ("model_year", "model_year_label", (0.0, 0.03, 0.1, 0.07), (0.36, 0.3, 0.12, 0.08), "below", (0.0, 0.004, 0.07, 0.065), "anchor_below_line", "digits", 4),
    ("owner_surname", "surname_label", (0.07, 0.0, 0.18, 0.06), (0.64, 0.14, 0.18, 0.06), "right", (0.002, 0.0, 0.14, 0.04), "anchor_right_line", "owner_text", 4),
    ("owner_name", "name_label", (0.07, 0.0, 0.18, 0.06), (0.64, 0.19, 0.18, 0.06), "right", (0.002, 0.0, 0.14, 0.04), "anchor_right_line", "owner_text", 4),
    ("first_registration_date", "first_registration_label", (0.0, 0.028, 0.15, 0.07), (0.23, 0.155, 0.17, 0.075), "below", (0.005, 0.003, 0.12, 0.065), "anchor_below_line", "date", 14),
    ("registration_date", "registration_label", (0.0, 0.028, 0.15, 0.07), (0.23, 0.21, 0.17, 0.075), "below", (0.005, 0.003, 0.12, 0.065), "anchor_below_line", "date", 14),
    ("inspection_date", "inspection_label", (0.0, 0.022, 0.18, 0.065), (0.64, 0.74, 0.22, 0.07), "below", (0.005, 0.003, 0.18, 0.08), "roi_line", "date", 12),
    ("serial_no", "serial_label", (0.0, 0.022, 0.22, 0.07), (0.64, 0.83, 0.26, 0.08), "right", (0.005, 0.002, 0.22, 0.04), "roi_line", "keep", 6),
]
# Least length, whether mixed letters and digits are preferred, and label prefixes to strip, of the fields that have any.
POST_CLEAN = {
    "engine_no": (0, False, ["MOTOR NO", "MOTORNO", "MOTOR N0", "PSMOTORNO", "PS MOTORNO", "P5MOTORNO", "P5 MOTORNO", "SMOTORNO", "S MOTORNO", "M0T0RN0", "M0T0R NO", "M0T0RNO"]),
    "type": (2, True, ["TIPI", "TIP", "TYPE"]),
    "owner_surname": (3, False, ["SOYADI", "TICARI UNVANI", "UNVANI"]),
    "owner_name": (2, False, ["ADI"]),
    "first_registration_date": (10, False, []),
    "registration_date": (10, False, []),
    "inspection_date": (10, False, []),
    "serial_no": (4, False, ["BELGE", "SERI", "SERI:"]),
}
BRANDS = "RENAULT FORD MERCEDES-BENZ VOLKSWAGEN TOYOTA HYUNDAI KIA BMW AUDI FIAT OPEL PEUGEOT CITROEN NISSAN HONDA MAZDA VOLVO SKODA SEAT DACIA MITSUBISHI SUZUKI ISUZU TATA SYM MONDIAL ARORA CITYCOCO CUSWA".split()
FIELD_ORDER = ["plate", "brand", "type", "model_year", "engine_no", "chassis_no", "tax_or_id_no", "owner_surname", "owner_name", "first_registration_date", "registration_date", "inspection_date", "serial_no"]
ANCHOR_COLUMNS = ["anchor", "min_score", "aliases", "rx", "ry", "rw", "rh"]
FIELD_COLUMNS = ["field", "anchor", "dx", "dy", "dw", "dh", "fx", "fy", "fw", "fh", "direction", "ml", "mt", "mr", "mb", "force_method", "strategy", "threshold", "min_len", "prefer_mixed", "prefixes"]


def anchor_rows() -> list[tuple]:
    return [(k, name, score, aliases, *region) for k, (name, score, aliases, region) in enumerate(ANCHORS)]


def field_rows() -> list[tuple]:
    return [(k, f, a, *off, *(fall or (None,) * 4), way, *margin, force, strategy, threshold, *POST_CLEAN.get(f, (0, False, []))) for k, (f, a, off, fall, way, margin, force, strategy, threshold) in enumerate(FIELDS)]


def anchor_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(anchor_rows(), "anchor_no int, anchor string, min_score double, aliases array<string>, rx double, ry double, rw double, rh double")


def field_rules(spark: SparkSession) -> DataFrame:
    numbers = ", ".join(f"{c} double" for c in "dx dy dw dh fx fy fw fh".split())
    margins = ", ".join(f"{c} double" for c in "ml mt mr mb".split())
    return spark.createDataFrame(field_rows(), f"field_no int, field string, anchor string, {numbers}, direction string, {margins}, force_method string, strategy string, threshold int, min_len int, prefer_mixed boolean, prefixes array<string>")
