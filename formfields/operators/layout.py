"""Text of nested layouts, labelled sections and summary records of marked-up pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import behind, collapsed, folded, shown
from ..scratch import dropped, written
from .words import markup_to_text

# Sections of a marked-up form, by the labels before and after them.
SECTIONS = {
    "place": ("\\(Y\\.I\\)\\s*VERILDIGI IL / ILCE", "\\(A\\)\\s*PLAKA"), "plate": ("\\(A\\)\\s*PLAKA", "\\(B\\)"), "first_registration_date": ("\\(B\\)\\s*ILK TESCIL TARIHI", "\\(Y\\.2\\)"), "registration_date": ("\\(I\\)\\s*TESCIL TARIHI", "\\(D\\.1\\)"),
    "brand": ("\\(D\\.1\\)\\s*MARKASI", "\\(D\\.2\\)"), "type": ("\\(D\\.3\\)\\s*TICARI ADI", "\\(D\\.4\\)"), "model_year": ("\\(D\\.4\\)\\s*MODEL YILI", "\\(J\\)"), "vehicle_class": ("\\(D\\.5\\)\\s*CINSI", "\\(R\\)"), "color": ("\\(R\\)\\s*RENGI", "\\(P\\.5\\)"),
    "engine_no": ("\\(P\\.5\\)\\s*MOTOR NO", "\\(E\\)"), "chassis_no": ("\\(E\\)\\s*SASE NO", "\\(G\\.1\\)"), "displacement": ("\\(P\\.1\\)\\s*SILINDIR HACMI", "\\(P\\.2\\)"), "power": ("\\(P\\.2\\)\\s*MOTOR GUCU", "\\(P\\.3\\)"),
    "tax_or_id_no": ("\\(Y\\.4\\)\\s*T\\.C\\. KIMLIK NO/VERGI NO", "\\(C\\.1\\.1\\)"), "owner_surname": ("\\(C\\.1\\.1\\)\\s*SOYADI/TICARI UNVANI", "\\(C\\.1\\.2\\)"), "owner_name": ("\\(C\\.1\\.2\\)\\s*ADI", "\\(C\\.1\\.3\\)"), "address": ("\\(C\\.1\\.3\\)\\s*ADRESI", "\\(Z\\.1\\)"),
    "inspection_date": ("\\(Z\\.2\\)\\s*DIGER BILGILER\\s*MUA\\.GEC\\.TRH:", "\\(Z\\.3\\.4\\)"), "approver": ("\\(Y\\.5\\)\\s*ONAYLAYAN SICIL-IMZA", "BELGE"), "serial_no": ("BELGE\\s*SERI\\.?", "$"),
}
SHOWN = ("brand", "type", "vehicle_class", "color", "displacement", "power", "owner_surname", "owner_name", "address", "serial_no", "place", "approver")
NEEDED = ("plate", "brand", "tax_or_id_no")
SECTIONS_AT_ONCE = 5
# What a summary record reads after its keywords, the first group of each.
SUMMARY = {
    "plate": "\\b([0-9]{2}[A-Z]{1,3}[0-9]{2,4})\\b", "first_registration_date": "ILK\\s+TESCIL\\s+TARIHI\\s+([0-9]{2}/[0-9]{2}/[0-9]{4})", "registration_date": "TESCIL\\s+TARIHI\\s+([0-9]{2}/[0-9]{2}/[0-9]{4})", "brand": "MARKASI\\s+([A-Z-]+)",
    "trade_name": "TICARI\\s+ADI\\s+(.+?)\\s+D\\.4\\s+MODEL\\s+YILI", "type": "TIPI\\s+(.+?)\\s+D\\.3\\s+TICARI\\s+ADI", "model_year": "D\\.4\\s+MODEL\\s+YILI\\s+(19[0-9]{2}|20[0-9]{2})", "tax_or_id_no": "T\\.?C\\.?\\s+KIMLIK\\s+NO/?VERGI\\s+NO\\s+([0-9]{10,11})",
    "engine_no": "\\b([A-Z0-9]{10,20})\\s+VF[A-Z0-9]{15}\\b", "chassis_no": "\\b[A-Z0-9]{10,20}\\s+(VF[A-Z0-9]{15})\\b", "displacement": "SILINDIR\\s+HACMI\\s+([0-9]+)\\s*CM\\S*\\s+MOTOR\\s+GUCU\\s+[0-9]+\\s*KW", "power": "SILINDIR\\s+HACMI\\s+[0-9]+\\s*CM\\S*\\s+MOTOR\\s+GUCU\\s+([0-9]+)\\s*KW",
    "inspection_date": "MUA\\.?GEC\\.?TRH\\s*:?\\s*([0-9]{2}-[0-9]{2}-[0-9]{4})", "owner_surname": "SOYADI/?TICARI\\s+UNVANI\\s+([A-Z]+)\\s+C\\.1\\.2\\s+ADI\\s+[A-Z]+", "owner_name": "SOYADI/?TICARI\\s+UNVANI\\s+[A-Z]+\\s+C\\.1\\.2\\s+ADI\\s+([A-Z]+)",
    "address": "C\\.1\\.3\\s+ADRESI\\s+(.+?)\\s+Z\\.1\\s+ARAC\\s+UZERINDE\\s+HAK", "named_class": "D\\.5\\s+CINSI\\s+(.+?)\\s+R\\s+RENGI", "named_color": "R\\s+RENGI\\s+(.+?)\\s+P\\.5\\s+MOTOR\\s+NO",
}
SERIAL = "BELGE\\s+SERI\\.?\\s*([A-Z]{2})\\s+NO\\s+([0-9]{5,7})"
COLORS = "((?:GRI|BEYAZ|SIYAH|MAVI|KIRMIZI)(?:\\s*\\([^)]+\\))?)$"
GATES = ("KIMLIK NO/VERGI NO", "TESCIL TARIHI")


def without_fences(text: Column) -> Column:
    """Text without code fences and the word markdown, blanks collapsed."""
    opened = F.regexp_replace(F.regexp_replace(F.trim(text), "^```(?:[A-Za-z0-9_-]+)?\\s*", ""), "\\s*```$", "")
    return collapsed(F.regexp_replace(F.replace(opened, F.lit("```"), F.lit(" ")), "(?i)\\bmarkdown\\b", " "))


def flatten_layout(layouts: DataFrame) -> DataFrame:
    """page_id and text of layouts (page_id, blocks: an array of arrays of structs with content, text, markdown and md): the texts in order, each once, one a line.

    A block gives its four texts as they stand, and then each of them again from the walk over its values; equal ones count once.
    """
    names = ("content", "text", "markdown", "md")
    parts = F.flatten(F.transform(F.flatten("blocks"), lambda b: F.array(*[without_fences(b[n]) for n in names])))
    kept = F.array_distinct(F.filter(parts, lambda p: p.isNotNull() & (p != "")))
    return layouts.select("page_id", F.array_join(F.coalesce(kept, F.array().cast("array<string>")), "\n").alias("text"))


# The texts of a block, in the order in which they count, and what is no text.
TEXTS = ("content", "text", "markdown", "md")
NO_TEXT = ("bbox", "bbox_2d", "index", "label", "type", "score", "page")


def layout_parts(layouts: DataFrame) -> DataFrame:
    """page_id, place and part: the texts of nested layouts (page_id, json) of any depth; places sort them in the order of the walk.

    Of an object first its own texts, then all its values in their order but those that are no text; of an array its
    items; a string is a text. One level of all pages is opened a round, until nothing is left to open, so the rounds are as
    many as the deepest layout has levels. Values keep the order of the document, which a VARIANT has not, so that only
    tells their kinds. JSON that can't be read has no parts.
    """
    kind = lambda v: F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    root = F.try_parse_json("json")
    unquoted = F.when(kind(root) == "STRING", F.variant_get(root, "$", "string")).otherwise(F.col("json"))
    left = layouts.select("page_id", F.array().cast("array<int>").alias("place"), unquoted.alias("text"), kind(root).alias("kind")).where("kind IN ('STRING', 'OBJECT', 'ARRAY')")
    parts = left.where("kind = 'STRING'").select("page_id", "place", F.col("text").alias("part"))
    left = left.where("kind <> 'STRING'")
    while True:
        # What the plan of a round grows by is cut off by a written table.
        left = written(left, "layout-level")
        if not left.limit(1).count():
            dropped(left)
            return parts
        objects, arrays = left.where("kind = 'OBJECT'"), left.where("kind = 'ARRAY'")
        texts, values = F.from_json("text", "map<string,string>"), F.from_json("text", "map<string,variant>")
        keyed = objects.select("page_id", "place", texts.alias("texts"), values.alias("values"))
        own = F.filter(F.array(*[F.struct(F.lit(k).alias("k"), F.when(kind(F.col("values")[n]) == "STRING", F.col("texts")[n]).alias("part")) for k, n in enumerate(TEXTS)]), lambda x: x["part"].isNotNull())
        direct = keyed.select("page_id", "place", F.inline(own)).select("page_id", F.array_append("place", F.col("k")).alias("place"), "part")
        opened = keyed.select("page_id", "place", "values", F.posexplode("texts").alias("k", "key", "text")).where(~F.col("key").isin(*NO_TEXT)).select("page_id", "place", "k", "text", kind(F.col("values")[F.col("key")]).alias("kind"))
        listed = arrays.select("page_id", "place", F.from_json("text", "array<variant>").alias("values"), F.posexplode(F.from_json("text", "array<string>")).alias("k", "text")).select("page_id", "place", "k", "text", kind(F.get("values", F.col("k"))).alias("kind"))
        below = opened.unionByName(listed).select("page_id", F.array_append("place", F.col("k") + len(TEXTS)).alias("place"), "text", "kind")
        parts = parts.unionByName(direct).unionByName(below.where("kind = 'STRING'").select("page_id", "place", F.col("text").alias("part")))
        left = below.where("kind IN ('OBJECT', 'ARRAY')")


def flatten_json(layouts: DataFrame) -> DataFrame:
    """page_id and text of nested layouts (page_id, json) of any depth: the parts of layout_parts without fences and blanks, each once where it first stands, one a line; '' for none."""
    parts = layout_parts(layouts).withColumn("part", without_fences(F.col("part"))).where("part <> ''")
    first = parts.groupBy("page_id", "part").agg(F.min("place").alias("place"))
    held = first.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("place", "part"))).alias("ps"))
    text = F.array_join(F.transform("ps", lambda p: p["part"]), "\n")
    return layouts.select("page_id").distinct().join(held, "page_id", "left").select("page_id", F.coalesce(text, F.lit("")).alias("text"))


def blocks_text(layouts: DataFrame) -> DataFrame:
    """page_id and text: the contents of the blocks of the first level, parted by empty lines."""
    contents = F.filter(F.transform(F.flatten("blocks"), lambda b: F.trim(b["content"])), lambda c: c.isNotNull() & (c != ""))
    return layouts.select("page_id", F.array_join(contents, "\n\n").alias("text"))


def flat_text(html: Column) -> Column:
    """Mark-up as one line of folded text."""
    text = F.regexp_replace(F.regexp_replace(F.replace(html, F.lit("\r"), F.lit("\n")), "(?i)<img[^>]*>", " "), "(?i)</(?:tr|table|td)>|<br\\s*/?>", "\n")
    return F.replace(folded(collapsed(F.regexp_replace(text, "<[^>]+>", " "))), F.lit("N°"), F.lit("NO"))


def labelled_sections(pages: DataFrame) -> DataFrame:
    """page_id and the text between the labels of each section, of pages (page_id, html) with a table that has a plate, a brand and a tax number; '' for sections that are missing."""
    read = behind(pages.where(F.contains(F.lower("html"), F.lit("<table"))).select("page_id", "html"), norm=flat_text(F.col("html"))).drop("html")
    grab = lambda a, b: collapsed(F.regexp_extract("norm", f"(?is){a}\\s*(.*?)\\s*{b}", 1))
    # A few sections at a time, so that the code made for a step stays small enough to be compiled.
    cells, names = read, list(SECTIONS)
    for k in range(0, len(names), SECTIONS_AT_ONCE):
        cells = behind(cells, **{name: grab(*SECTIONS[name]) for name in names[k : k + SECTIONS_AT_ONCE]})
    final = {
        "serial_no": F.trim(F.regexp_replace("serial_no", "N°|NO", "")),
        "approver": F.regexp_replace("approver", "\\s+(S\\.N\\.Y\\.[0-9]+)\\s*$", " ($1)"),
    }
    kept = cells.where(" AND ".join(f"{c} <> ''" for c in NEEDED))
    value = lambda name: final.get(name, F.col(name))
    return kept.select("page_id", *[(shown(value(n)) if n in SHOWN else value(n)).alias(n) for n in SECTIONS])


def summary_records(pages: DataFrame) -> DataFrame:
    """page_id and what the keywords of a form's running text give, of pages (page_id, html) that have both key phrases, a plate, a brand and a tax number; '' for what is missing.

    The vehicle's class and colour are those after their keywords, else what stands between the class of the vehicle and the engine's number.
    """
    lines = markup_to_text(pages).groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("line_no", "text"))).alias("ls"))
    joined = F.replace(F.replace(collapsed(F.array_join(F.transform("ls", lambda x: x["text"]), " ")), F.lit("N°"), F.lit("NO")), F.lit("№"), F.lit("NO"))
    read = behind(behind(lines, joined=joined), norm=folded(F.col("joined"))).drop("ls")
    gated = read.where(F.contains("norm", F.lit(GATES[0])) & F.contains("norm", F.lit(GATES[1])))
    cells = behind(gated, **{name: F.trim(F.regexp_extract("norm", p, 1)) for name, p in SUMMARY.items()}, series=F.regexp_extract("norm", SERIAL, 1), number=F.regexp_extract("norm", SERIAL, 2))
    kept = cells.where(" AND ".join(f"{c} <> ''" for c in NEEDED))
    before = lambda column: F.get(F.split("norm", F.concat(F.lit("\\Q"), F.col(column), F.lit("\\E")), 2), 0)
    tail = F.when(F.col("engine_no") != "", F.trim(F.regexp_extract(before("engine_no"), "ARAC\\s+SINIFI\\s+[A-Z0-9]+\\s+(.+)$", 1))).otherwise("")
    more = behind(kept, tail=tail, place=F.regexp_replace(F.regexp_replace(before("plate"), "^.*?VERILDIGI\\s+IL\\s*/\\s*ILCE\\s*", ""), "^[ :/-]+|[ :/-]+$", ""), approver=F.trim(F.regexp_extract("joined", "(?i)ONAYLAYAN\\s+SICIL-IMZA\\s+(.+?)\\s+S\\.N\\.Y\\.[0-9]+", 1)), sign=F.regexp_extract("joined", "(?i)(S\\.N\\.Y\\.[0-9]+)", 1))
    color = F.regexp_extract("tail", COLORS, 1)
    first = lambda *columns: F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))
    return more.select(
        "page_id", "plate", shown(F.col("brand")).alias("brand"), shown(first(F.col("trade_name"), F.col("type"))).alias("type"), "model_year", "chassis_no", "engine_no", "first_registration_date", "registration_date",
        shown(first(F.col("named_class"), F.trim(F.regexp_replace("tail", COLORS, "")))).alias("vehicle_class"), shown(first(F.col("named_color"), color)).alias("color"), "displacement", "power", "tax_or_id_no",
        shown(F.col("owner_name")).alias("owner_name"), shown(F.col("owner_surname")).alias("owner_surname"), shown(F.col("address")).alias("address"), F.trim(F.concat_ws(" ", "series", "number")).alias("serial_no"), shown(F.col("place")).alias("place"), "inspection_date",
        F.when(F.col("approver") != "", F.concat("approver", F.lit(" ("), "sign", F.lit(")"))).otherwise("").alias("approver"),
    )
