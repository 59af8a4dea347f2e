"""Text normal forms and value standardisation as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Turkish letters and their ASCII capitals, words that are labels rather than values (of any field, of
# owners, of types), the pattern of a plate, and words that are shown with Turkish letters.
FOLD_FROM = "ÇĞİÖŞÜÂÎÛçğıiöşüâîû"
FOLD_TO = "CGIOSUAIUCGIIOSUAIU"
LABEL_WORDS = "PLAKA MARKASI MARKA TIPI TIP MODEL YILI MOTOR SASE SERI BELGE TESCIL TARIHI DIGER BILGILER NOTER SOYADI ADI VERGI NO".split()

OWNER_LABELS = "SOYADI ADI TICARI UNVANI UNVAN ADRESI ADRES NOTER"
TYPE_LABELS = "TIPI TIP TYPE MODEL YILI MARKASI MARKA"
PLATE = "^[0-9]{2}[A-Z]{1,3}[0-9]{2,4}$"
DISPLAY_WORDS = {
    "GRI": "GRİ", "ESKISEHIR": "ESKİŞEHİR", "ESKISEHR": "ESKİŞEHİR", "TEPEBASI": "TEPEBAŞI", "ULUONDER": "ULUÖNDER", "NOTERLIGI": "NOTERLİĞİ",
    "VERILDIGI": "VERİLDİĞİ", "KIMLIK": "KİMLİK", "OTOMOBIL": "OTOMOBİL", "BENZINLI": "BENZİNLİ", "TITANYUM": "TİTANYUM",
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of the value, which is computed once however often body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def behind(df: DataFrame, **made: Column) -> DataFrame:
    """df with further columns that stand behind a Generate, so that expressions over them read them rather than repeat their work."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in made.items()]))))


def folded(text: Column) -> Column:
    """Upper-case ASCII form of Turkish text; other letters are upper-cased only."""
    return F.upper(F.translate(text, FOLD_FROM, FOLD_TO))


def collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "(?U)\\s+", " "))


def match_form(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(folded(text), "[^A-Z0-9 ]+", " "), " +", " "))


def null_if_blank(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def is_run(text: Column) -> Column:
    """Whether the text is one run of capitals and digits, as most values are; it meets few of the patterns then."""
    return F.rlike(text, F.lit("^[A-Z0-9]+\\z"))


def clean_plate(raw: Column) -> Column:
    """The first run of one to four tokens whose concatenation is a plate; else the tokens together."""
    return plate_of(folded(raw))


def plate_of(upper: Column) -> Column:
    def read(tokens: Column) -> Column:
        runs = F.flatten(F.transform(tokens, lambda _t, i: F.transform(F.sequence(F.lit(1), F.least(F.lit(4), F.size(tokens) - i)), lambda n: F.array_join(F.slice(tokens, i + 1, n), ""))))
        return F.coalesce(F.get(F.filter(runs, lambda r: F.rlike(r, F.lit(PLATE))), 0), F.array_join(tokens, ""))

    def joined(text: Column) -> Column:
        # Runs are only looked for where there are several tokens and a plate somewhere in what they make together.
        whole = F.replace(text, F.lit(" "), F.lit(""))
        return F.when(F.contains(text, F.lit(" ")) & F.rlike(whole, F.lit(PLATE[1:-1])), let(F.split(text, " "), read)).otherwise(whole)

    return let(F.trim(F.regexp_replace(upper, "[^A-Z0-9]+", " ")), joined)


def first_longest(items: Column) -> Column:
    """The longest string of an array, the first one among equals; '' for none."""
    return F.aggregate(items, F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best))


def clean_digits(raw: Column) -> Column:
    several = F.rlike(raw, F.lit("[0-9][^0-9]+[0-9]"))
    return F.when(several, first_longest(F.regexp_extract_all(raw, F.lit("([0-9]+)"), 1))).otherwise(F.regexp_extract(raw, "[0-9]+", 0))


def clean_date(raw: Column) -> Column:
    """dd/mm/yyyy from day, month and year parted by / . or -; two-digit years are of this century; '' where there is none."""
    return date_of(folded(raw))


def date_of(upper: Column) -> Column:
    pattern = "([0-9]{1,2})\\s*/\\s*([0-9]{1,2})\\s*/\\s*([0-9]{2,4})"

    def read(text: Column) -> Column:
        day, month, year = (F.regexp_extract(text, pattern, k) for k in (1, 2, 3))
        return F.when(F.contains(text, F.lit("/")) & (year != ""), F.concat_ws("/", F.lpad(day, 2, "0"), F.lpad(month, 2, "0"), F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year))).otherwise("")

    return let(F.translate(upper, ".-", "//"), read)


def is_mixed(text: Column) -> Column:
    return F.rlike(text, F.lit("[A-Z]")) & F.rlike(text, F.lit("[0-9]"))


def alnum_token(raw: Column) -> Column:
    """The token of letters, digits and hyphens with the most letters and digits, those with both preferred, the first among equals."""
    return token_of(folded(raw))


def token_of(upper: Column) -> Column:
    size = lambda t: F.length(F.replace(t, F.lit("-"), F.lit("")))
    longest = lambda items: F.aggregate(items, F.lit(""), lambda best, x: F.when(size(x) > size(best), x).otherwise(best))
    read = lambda tokens: let(F.filter(tokens, is_mixed), lambda mixed: longest(F.when(F.size(mixed) > 0, mixed).otherwise(tokens)))
    return let(F.regexp_extract_all(upper, F.lit("([A-Z0-9-]+)"), 1), read)


def clean_alnum(raw: Column) -> Column:
    return F.replace(alnum_token(raw), F.lit("-"), F.lit(""))


def clean_text(raw: Column) -> Column:
    return plain_of(folded(raw))


def plain_of(upper: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(upper, "[^A-Z0-9 ./-]+", " "), " +", " "))


def without_words(text: Column, words: str) -> Column:
    """The text without these whole words, blanks collapsed."""
    return collapsed(F.regexp_replace(text, "\\b(?:" + words.replace(" ", "|") + ")\\b", " "))


def clean_owner(raw: Column) -> Column:
    """Up to ten parts of two characters or more, without the words of an owner's labels."""
    return owner_of(without_words(clean_text(raw), OWNER_LABELS))


def owner_of(text: Column) -> Column:
    parts = F.filter(F.split(text, " "), lambda w: F.length(w) > 1)
    return F.array_join(F.slice(parts, 1, 10), " ")


def clean_type(raw: Column) -> Column:
    """A vehicle type without label words: a token alone, else up to three tokens that mix letters and digits, else up to four."""
    return type_of(without_words(clean_text(raw), TYPE_LABELS))


def type_of(text: Column) -> Column:
    def read(tokens: Column) -> Column:
        mixed = F.filter(tokens, is_mixed)
        return F.array_join(F.when((F.size(tokens) > 1) & F.exists(tokens, is_mixed), F.slice(mixed, 1, 3)).otherwise(F.slice(tokens, 1, 4)), " ")

    return let(F.regexp_extract_all(text, F.lit("([A-Z0-9.-]+)"), 1), read)


STRATEGIES = {"plate": clean_plate, "digits": clean_digits, "date": clean_date, "alnum_upper": clean_alnum, "alnum_hyphen_upper": alnum_token, "text_upper": clean_text, "owner_text": clean_owner, "vehicle_type": clean_type, "keep": collapsed}


def standard_values(lines: DataFrame, *kept: str) -> DataFrame:
    """What each strategy makes of `text`, a column for each, NULL when empty; kept are the other columns.

    What several strategies need of a text is computed once, each step from the one before. A text that is one run of
    capitals and digits, as most lines are, is its own value under most strategies and meets no further pattern.
    """
    text, upper, plain, run = (F.col(c) for c in ("text", "upper", "plain", "one_run"))
    unless_run = lambda known, other: F.when(run, known).otherwise(other)
    told = lines.select(*kept, "text", F.rlike(text, F.lit("^[A-Z0-9]+\\z")).alias("one_run"), F.rlike(text, F.lit("^[!-~]+(?: [!-~]+)*\\z")).alias("tidy"))
    raised = told.select("*", unless_run(text, folded(text)).alias("upper"))
    plained = raised.select("*", unless_run(text, plain_of(upper)).alias("plain"))
    # plain has single blanks only, so that without a label word nothing is left to collapse.
    without = lambda labels: F.when(F.rlike(plain, F.lit("\\b(?:" + labels.replace(" ", "|") + ")\\b")), without_words(plain, labels)).otherwise(plain)
    parted = plained.select("*", without(OWNER_LABELS).alias("owner"), without(TYPE_LABELS).alias("kind"))
    values = {
        "plate": unless_run(text, plate_of(upper)), "digits": clean_digits(text), "date": F.when(~run & F.rlike(upper, F.lit("[0-9]")), date_of(upper)), "alnum_hyphen_upper": unless_run(text, token_of(upper)), "text_upper": plain,
        "owner_text": F.when(run, F.when(F.length("owner") > 1, F.col("owner"))).otherwise(owner_of(F.col("owner"))), "vehicle_type": unless_run(F.col("kind"), type_of(F.col("kind"))), "keep": F.when(F.col("tidy"), text).otherwise(collapsed(text)),
    }
    made = parted.select(*kept, *[c.alias(name) for name, c in values.items()])
    every = {"alnum_upper": F.replace("alnum_hyphen_upper", F.lit("-"), F.lit(""))}
    return made.select(*kept, *[null_if_blank(every.get(name, F.col(name))).alias(name) for name in STRATEGIES])


def cleaned(strategy: Column, raw: Column) -> Column:
    """The raw value under the strategy that its row names; other names keep the collapsed text. NULL when empty."""
    out = None
    for name, build in STRATEGIES.items():
        out = F.when(strategy == name, build(raw)) if out is None else out.when(strategy == name, build(raw))
    return F.when(is_run(raw), cleaned_run(strategy, raw)).otherwise(null_if_blank(out.otherwise(collapsed(raw))))


def cleaned_run(strategy: Column, run: Column) -> Column:
    """What `cleaned` makes of one run of capitals and digits."""
    return (
        F.when(strategy == "digits", null_if_blank(clean_digits(run))).when(strategy == "date", F.lit(None)).when(strategy == "owner_text", F.when((F.length(run) > 1) & ~run.isin(OWNER_LABELS.split()), run))
        .when(strategy == "vehicle_type", F.when(~run.isin(TYPE_LABELS.split()), run)).otherwise(run)
    )


def fixed_vin(raw: Column) -> Column:
    """A chassis number of 15 to 17 characters: of the first three O reads 0, of the rest O and Q read 0 and I reads 1; an 18th is cut off; NULL else."""
    text = F.upper(F.trim(raw))
    repaired = F.concat(F.translate(F.substring(text, 1, 3), "O", "0"), F.translate(F.substring(text, 4, 1 << 20), "OQI", "001"))
    code = F.regexp_replace(repaired, "[^A-Z0-9]", "")
    cut = F.when(F.length(code) == 18, F.substring(code, 1, 17)).otherwise(code)
    return F.when(F.length(cut).between(15, 17), cut)


def fixed_date(raw: Column) -> Column:
    """The first date in the text as dd/mm/yyyy, its parts in range and its year in 1900 to 2100; NULL else."""
    pattern = "([0-9]{1,2})[/.-]([0-9]{1,2})[/.-]([0-9]{2,4})"
    part = lambda k: F.regexp_extract(raw, pattern, k)
    year = F.when(F.length(part(3)) == 2, F.concat(F.lit("20"), part(3))).otherwise(part(3))
    number = lambda c: F.nullif(c, F.lit("")).cast("int")
    fits = number(part(1)).between(1, 31) & number(part(2)).between(1, 12) & number(year).between(1900, 2100)
    return F.when(fits, F.concat_ws("/", F.lpad(part(1), 2, "0"), F.lpad(part(2), 2, "0"), number(year).cast("string")))


def fixed_plate(raw: Column) -> Column:
    """A plate, O and I of its first two places read as digits; text that is none even then stays as it was, without blanks."""
    text = F.regexp_replace(F.upper(raw), "\\s+", "")
    repaired = F.concat(F.translate(F.substring(text, 1, 2), "OI", "01"), F.substring(text, 3, 1 << 20))
    return F.when(F.rlike(repaired, F.lit(PLATE)), repaired).otherwise(text)


def fixed_engine(raw: Column) -> Column:
    """Beyond the three characters of the maker's code, O reads 0 and I reads 1."""
    text = F.upper(F.trim(raw))
    return F.concat(F.substring(text, 1, 3), F.translate(F.substring(text, 4, 1 << 20), "OI", "01"))


def last_of(text: Column, pattern: str) -> Column:
    """The last match of the pattern; NULL for none."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(f"({pattern})"), 1), F.lit(-1))


def validated(field: Column, value: Column) -> Column:
    """The final form of a field's value, NULL where it can't be one."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    letters = F.regexp_replace(F.upper(value), "[^A-ZÇĞİÖŞÜ-]", "")
    return (
        F.when(field == "plate", fixed_plate(value))
        .when(field == "chassis_no", fixed_vin(value))
        .when(field == "engine_no", fixed_engine(value))
        .when(field.isin("first_registration_date", "registration_date", "inspection_date"), fixed_date(value))
        .when(field == "model_year", null_if_blank(F.regexp_extract(value, "\\b(19[5-9][0-9]|20[0-3][0-9])\\b", 1)))
        .when(field == "tax_or_id_no", F.when(F.length(digits).isin(10, 11), digits).otherwise(null_if_blank(F.regexp_extract(value, "([0-9]{10,11})", 1))))
        .when(field == "serial_no", last_of(value, "[0-9]{4,7}"))
        .when(field == "brand", F.when(F.length(letters) >= 2, F.upper(value)))
        .otherwise(F.trim(value))
    )


def vin_in_context(value: Column) -> Column:
    """A chassis number of 15 to 18 characters with what its neighbours tell: 8 after a letter reads B, 5 between letters S, V then E reads VF, and I after VF or VE reads 1. NULL for other lengths.

    Each place sees the repairs of those before it.
    """
    letter = lambda c: F.rlike(c, F.lit("^[A-Z]$"))

    def read(code: Column) -> Column:
        def step(done: Column, i: Column) -> Column:
            here, before, after = F.substr(code, i, F.lit(1)), F.right(done, F.lit(1)), F.substr(code, i + 1, F.lit(1))
            return F.concat(done, (
                F.when((here == "8") & letter(before), "B").when((here == "5") & letter(before) & letter(after), "S")
                .when((here == "E") & (i == 2) & (done == "V"), "F").when((here == "I") & (i == 3) & done.isin("VF", "VE"), "1").otherwise(here)
            ))

        return F.when(F.length(code).between(15, 18), F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(code), F.lit(1))), F.lit(""), step))

    return let(F.regexp_replace(F.upper(value), "[^A-Z0-9]", ""), read)


def only_allowed(text: Column, allowed: Column) -> Column:
    """The characters of the text that the whitelist holds; all of them where it is NULL."""
    kept = F.array_join(F.filter(F.split(text, ""), lambda c: F.contains(allowed, c)), "")
    return F.when(allowed.isNull(), text).otherwise(kept)


def shown(text: Column) -> Column:
    """Text with the display words in Turkish letters: one pass over its words and what stands between them."""
    restored = F.create_map(*[F.lit(w) for pair in DISPLAY_WORDS.items() for w in pair])
    pieces = F.regexp_extract_all(text, F.lit("([A-Za-z0-9_]+|[^A-Za-z0-9_]+)"), 1)
    return F.array_join(F.transform(pieces, lambda w: F.coalesce(restored[w], w)), "")
