"""What makes a cleaned value acceptable for its field: prefixes, least lengths and the filters of each field, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import LABEL_WORDS, PLATE, clean_plate, collapsed, folded, is_mixed, is_run, last_of, let

# Words of companies' names, words and classes that are no vehicle type, and labels that are read as surnames.
COMPANY_WORDS = "TICARI UNVANI UNVAN LIMITED LTD SIRKETI SAN SANAYI TURIZM OTOMOTIV KIRTASIYE PROMOSYON OFIS UR URUN IMAL".split()
TYPE_BLOCK = "M S NO KG KW CM3 MODEL YILI ARAC SINIFI SASE MOTOR".split()
TYPE_NOISE = (
    "D D4 D.4 TABLE BORDER TARIHI YONET MARKDOWN UTF-8 ADI SOYADI MODEL YILI BEYAZ SIYAH GRI KIRMIZI MAVI SARI YESIL LACIVERT TURUNCU KAHVERENGI RENGI "
    "L0 L1 L2 L3 L4 L5 L6 L7 M1 M2 M3 N1 N2 N3 O1 O2 O3 O4"
).split()
GENERIC_TYPES = "KLET MOBIL OTOMOBIL MOTOSIKLET KAMYONET MINIBUS".split()
NO_SURNAMES = ["TESCIL TARIHI", "TESCIL TARIH", "TARIHI", "TESCIL", "VERGI DAIRESI", "VERGI NO", "MARKA", "MARKASI"]
ADDRESS_START = "\\b(?:ADRESI|ADRES|MAH\\.?|CAD\\.?|SOK\\.?|NO\\b)\\b"
ADDRESS_WORDS = "\\b(?:MAH\\.?|MAHALLESI|CAD\\.?|CADDESI|SOK\\.?|SOKAK|NO\\b|TEPEBASI|ESKISEHIR|ADRES(?:I)?)\\b"
TYPE_BLEED = "\\b(?:ADRESI|SOYADI|ADI|VERGI|TESCIL)\\b"


def tokens_of(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)


def without_prefixes(value: Column, prefixes: Column) -> Column:
    """The value, blanks collapsed, without label prefixes at its start."""
    def strip(text: Column, prefix: Column) -> Column:
        return F.when(F.startswith(text, prefix), F.regexp_replace(F.substr(text, F.length(prefix) + 1), "^[ :/-]+", "")).otherwise(text)

    text = F.when(is_run(value), value).otherwise(collapsed(value))
    return F.when(F.size(prefixes) > 0, F.aggregate(F.coalesce(prefixes, F.array().cast("array<string>")), text, lambda t, p: strip(t, folded(p)))).otherwise(text)


def accepted(text: Column, min_len: Column, prefer_mixed: Column) -> Column:
    """The text; NULL when empty, shorter than min_len or, where mixed values are preferred, neither mixed nor a short code."""
    long_enough = F.length(F.regexp_replace(text, "\\s+", "")) >= F.coalesce(min_len, F.lit(0))
    good = ~F.coalesce(prefer_mixed, F.lit(False)) | is_mixed(text) | F.rlike(text, F.lit("^[A-Z]{2,6}[0-9]{0,3}$"))
    return F.when(long_enough & good, F.nullif(text, F.lit("")))


def post_clean(value: Column, prefixes: Column, min_len: Column, prefer_mixed: Column) -> Column:
    """The cleaned value without its label prefixes, where it is accepted."""
    return let(without_prefixes(value, prefixes), lambda text: accepted(text, min_len, prefer_mixed))


def is_label_noise(value: Column) -> Column:
    """No token, one of two characters or fewer, or all tokens but at most one are label words."""
    def noise(tokens: Column) -> Column:
        return (F.size(tokens) == 0) | ((F.size(tokens) == 1) & (F.length(F.get(tokens, 0)) <= 2)) | (F.size(F.filter(tokens, lambda t: t.isin(LABEL_WORDS))) >= F.greatest(F.lit(1), F.size(tokens) - 1))

    return let(tokens_of(folded(value), "[A-Z0-9]+"), noise)


def surname(text: Column) -> Column:
    """A person's surname (two words of three letters or more at most) or a company's name (eight words at most)."""
    without = F.regexp_replace(F.regexp_replace(text, "\\b(?:SOYADI|ADI)\\b", " "), "\\bTICARI\\s+UNVAN[I1]?\\b", "TICARI UNVANI")

    def name(words: Column) -> Column:
        company = F.filter(words, lambda t: (F.length(t) >= 2) & ~t.isin("NOTER", "TESCIL", "TARIHI"))
        return F.array_join(F.when(F.exists(words, lambda t: t.isin(COMPANY_WORDS)), F.slice(company, 1, 8)).otherwise(F.slice(F.filter(words, lambda t: F.length(t) >= 3), 1, 2)), " ")

    body = collapsed(F.regexp_replace(F.get(F.split(without, ADDRESS_START), 0), "\\b[0-9]{2,}\\b", " "))
    return F.when(~text.isin(NO_SURNAMES), let(body, lambda b: F.when(F.length(b) >= 3, let(tokens_of(b, "[A-Z]+"), name))))


def given_name(text: Column) -> Column:
    return let(tokens_of(text, "[A-Z]+"), lambda words: F.when(~F.exists(words, lambda t: t.isin(COMPANY_WORDS)), F.array_join(F.slice(F.filter(words, lambda t: F.length(t) >= 2), 1, 3), " ")))


def vehicle_type(text: Column) -> Column:
    able = F.filter(tokens_of(text, "[A-Z0-9.-]+"), lambda t: ~t.isin(TYPE_BLOCK) & ~t.isin(TYPE_NOISE) & ~F.rlike(t, F.lit("^[0-9]{4}$")) & ~F.rlike(t, F.lit("^D\\.?[0-9]+$")))
    return F.when(~text.isin(GENERIC_TYPES), F.array_join(F.slice(able, 1, 6), " "))


def chassis_code(code: Column) -> Column:
    repaired = F.concat(F.translate(F.substring(code, 1, 3), "OQ", "00"), F.translate(F.substring(code, 4, 1 << 20), "OQI", "001"))
    return F.when(F.length(code) >= 12, F.when(F.length(code) >= 16, repaired).otherwise(code))


def engine_code(code: Column) -> Column:
    """O and Q beside a digit read 0, I beside a digit reads 1; each place sees the repairs before it."""
    digit = lambda c: F.rlike(c, F.lit("^[0-9]$"))

    def step(done: Column, i: Column) -> Column:
        here, after = F.substr(code, i, F.lit(1)), F.substr(code, i + 1, F.lit(1))
        beside = digit(F.right(done, F.lit(1))) | digit(after)
        inner = (i > 1) & (i < F.length(code))
        return F.concat(done, F.when(here.isin("O", "Q") & inner & beside, "0").when((here == "I") & (i > 3) & beside, "1").otherwise(here))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(code), F.lit(1))), F.lit(""), step)


def valid_date(text: Column) -> Column:
    """A date in dd/mm/yyyy whose parts are in range and whose year is in 1950 to 2035."""
    number = lambda at, n: F.substring(text, at, n).try_cast("int")
    return F.when(F.rlike(text, F.lit("^[0-9]{2}/[0-9]{2}/[0-9]{4}$")) & number(1, 2).between(1, 31) & number(4, 2).between(1, 12) & number(7, 4).between(1950, 2035), text)


DATE_FIELDS = ("first_registration_date", "registration_date", "inspection_date")
NAMED_FIELDS = ("brand", "serial_no", "owner_surname", "owner_name", "type")


def field_filter(field: Column, value: Column) -> Column:
    """The value as its field may have it, NULL where it may not. Brands pass when they are no label; their dictionary is a step of its own.

    Values of one run of capitals and digits, as most are, and dates meet no function over tokens.
    """
    owner = field.isin("owner_surname", "owner_name")
    return F.when(is_run(value) & ~(owner & is_mixed(value)), filtered_run(field, value)).when(field.isin(*DATE_FIELDS), valid_date(value)).otherwise(filtered_text(field, value))


def filtered_run(field: Column, run: Column) -> Column:
    """filtered_text of one run of capitals and digits; an owner's is of one kind."""
    letters = ~F.rlike(run, F.lit("[0-9]"))
    code = lambda body: F.when((F.length(run) >= 8) & ~run.isin(LABEL_WORDS), body)
    no_type = run.isin(GENERIC_TYPES) | run.isin(TYPE_BLOCK) | run.isin(TYPE_NOISE) | F.rlike(run, F.lit("^(?:[0-9]{4}|D[0-9]+)$"))
    named = (
        F.when(field == "brand", run).when(field == "serial_no", last_of(run, "[0-9]{4,7}")).when(field == "owner_surname", F.when(letters & ~run.isin(NO_SURNAMES) & ~F.rlike(run, F.lit(f"^(?:{ADDRESS_START})")), run))
        .when(field == "owner_name", F.when(letters & ~run.isin(COMPANY_WORDS), run)).otherwise(F.when(~no_type, run))
    )
    return (
        F.when(field == "plate", F.when(F.rlike(run, F.lit(PLATE)), run)).when(field.isin(*NAMED_FIELDS), F.when((F.length(run) > 2) & ~run.isin(LABEL_WORDS), named))
        .when(field == "engine_no", code(F.when(F.rlike(run, F.lit("[OQI]")), engine_code(run)).otherwise(run))).when(field == "chassis_no", code(chassis_code(run)))
        .when(field == "tax_or_id_no", F.when(F.length(F.regexp_replace(run, "[^0-9]", "")).isin(10, 11), F.regexp_replace(run, "[^0-9]", ""))).when(field.isin(*DATE_FIELDS), F.lit(None)).otherwise(run)
    )


def filtered_text(field: Column, value: Column) -> Column:
    """field_filter of any text."""
    def read(text: Column) -> Column:
        code = lambda body: let(F.regexp_replace(text, "[^A-Z0-9]", ""), lambda c: F.when((F.length(c) >= 8) & ~c.isin(LABEL_WORDS), body(c)))
        named = F.when(field == "brand", text).when(field == "serial_no", last_of(text, "[0-9]{4,7}")).when(field == "owner_surname", surname(text)).when(field == "owner_name", given_name(text)).otherwise(vehicle_type(text))
        return (
            F.when(field == "plate", let(clean_plate(text), lambda p: F.when(F.rlike(p, F.lit(PLATE)), p)))
            .when(field.isin(*NAMED_FIELDS), F.when(~is_label_noise(text), named))
            .when(field == "engine_no", code(engine_code)).when(field == "chassis_no", code(chassis_code))
            .when(field == "tax_or_id_no", let(F.regexp_replace(text, "[^0-9]", ""), lambda d: F.when(F.length(d).isin(10, 11), d)))
            .when(field.isin(*DATE_FIELDS), valid_date(text))
            .otherwise(text)
        )

    return let(let(folded(value), read), lambda v: F.nullif(F.trim(v), F.lit("")))
