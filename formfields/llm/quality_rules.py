"""Quality rules: a threshold table compiled into one projection of ratios. DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is was for that with on as are it by at from this be or an he not "
    "der die das und den von zu mit sich des im nicht ist ein eine auf für dem "
    "de la le et les en un une du que dans est pour par sur au qui "
    "el los las y se por con para del como su al lo es"
).split()

# metric, lowest and highest value that passes (None: no bound). All ratios are per word unless named otherwise.
THRESHOLDS: list[tuple[str, float | None, float | None]] = [
    ("n_words", 50, None),
    ("mean_word_chars", 3.0, 10.0),
    ("symbol_ratio", None, 0.1),
    ("shout_ratio", None, 0.3),
    ("stop_ratio", 0.02, None),
    ("dup_line_ratio", None, 0.5),
    ("bullet_line_ratio", None, 0.9),
    ("ellipsis_line_ratio", None, 0.3),
]

SPACE = "[\\\\x20\\\\x09-\\\\x0D]"


def barrier(df: DataFrame, *columns: str, **made: str) -> DataFrame:
    """Add columns behind a Generate, so that later expressions read them rather than repeat their work."""
    cell = F.expr("array(struct(" + ", ".join(f"{e} AS {c}" for c, e in made.items()) + "))")
    return df.select(*columns, F.inline(cell))


def compiled(thresholds: list[tuple[str, float | None, float | None]]) -> Column:
    """True where every metric lies within its bounds; a null metric fails."""
    tests = []
    for metric, low, high in thresholds:
        if low is not None:
            tests.append(f"{metric} >= {low}")
        if high is not None:
            tests.append(f"{metric} <= {high}")
    return F.expr("coalesce(" + (" AND ".join(tests) or "true") + ", false)")


def quality_metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and ratios of every row (null text: empty). Rows that repeat give a row each; other columns are ignored."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    base = docs.select(F.col(id_col).alias("rid"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    split = barrier(base, "rid", "t", words=f"filter(split(t, '{SPACE}+'), w -> w <> '')", lines=f"filter(split(t, '\\n'), l -> rlike(l, '[^\\\\x20\\\\x09-\\\\x0D]'))")
    counted = barrier(
        split, "rid", "words",
        n_words="CAST(size(words) AS long)",
        word_chars="CAST(char_length(array_join(words, '')) AS long)",
        n_symbols="CAST(char_length(t) - char_length(translate(t, '#*$%&|<>', '')) AS long)",
        n_shouts="CAST(char_length(t) - char_length(replace(t, '!', '')) AS long)",
        n_stop=f"CAST(size(filter(words, w -> lower(w) IN ({stop}))) AS long)",
        n_lines="size(lines)",
        n_dup_lines="CAST(size(lines) - size(array_distinct(lines)) AS long)",
        n_bullets="size(filter(lines, l -> rlike(l, '^[\\\\x20\\\\t]*[-*\\u2022]')))",
        n_ellipses="size(filter(lines, l -> rlike(l, '(\\\\.\\\\.\\\\.|\\u2026)[\\\\x20\\\\t\\\\r]*$')))",
    )
    counts = [c for c in counted.columns if c not in ("rid", "words")]
    hashes = barrier(counted, "rid", *counts, h="transform(words, w -> xxhash64(w))")
    # One 64-bit hash for each window of three words; within one text they don't collide in practice.
    windows = barrier(hashes, "rid", *counts, w3="IF(size(h) < 3, CAST(array() AS array<bigint>), zip_with(zip_with(slice(h, 1, size(h) - 2), slice(h, 2, size(h) - 2), (a, b) -> xxhash64(a, b)), slice(h, 3, size(h) - 2), (a, b) -> xxhash64(a, b)))")
    order = barrier(windows, "rid", *counts, s="IF(size(array_distinct(w3)) = size(w3), CAST(array() AS array<struct<h:bigint,i:int>>), array_sort(transform(w3, (h, i) -> struct(h AS h, i AS i))))")
    # Windows equal to a neighbour in hash order are found twice or more; their places, in text order.
    places = barrier(order, "rid", *counts, p="array_sort(transform(filter(s, (x, i) -> coalesce(get(s, i - 1).h = x.h, false) OR coalesce(get(s, i + 1).h = x.h, false)), x -> x.i))")
    covered = "aggregate(zip_with(p, slice(p, 2, greatest(size(p), 1)), (a, b) -> least(3, coalesce(b - a, 3))), 0L, (acc, v) -> acc + v)"
    out = places.withColumn("n_repeat_words", F.expr(f"IF(size(p) = 0, 0L, {covered})"))
    per_word = "CAST({} AS double) / greatest(n_words, 1)"
    per_line = "CAST({} AS double) / greatest(n_lines, 1)"
    return out.selectExpr(
        f"rid AS {id_col}", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        f"{per_word.format('word_chars')} AS mean_word_chars", f"{per_word.format('n_symbols')} AS symbol_ratio", f"{per_word.format('n_shouts')} AS shout_ratio",
        f"{per_word.format('n_stop')} AS stop_ratio", f"{per_line.format('n_dup_lines')} AS dup_line_ratio",
        f"{per_line.format('n_bullets')} AS bullet_line_ratio", f"{per_line.format('n_ellipses')} AS ellipsis_line_ratio",
    )


def quality_rules(docs: DataFrame, thresholds: list[tuple[str, float | None, float | None]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """quality_metrics with base_failed (under 50 words, or over half the words in repeated windows) and kept.

    kept is false where base_failed, else the verdict of the threshold table, which has no upper bound on length. Empty
    and null texts fail, a null id doesn't. Rows that repeat give a row each; an empty table gives none. Other columns
    are ignored, whatever their names.
    """
    scored = quality_metrics(docs, id_col, text_col)
    failed = scored.withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))
    return failed.withColumn("kept", ~F.col("base_failed") & compiled(THRESHOLDS if thresholds is None else thresholds))


def keep_good(docs: DataFrame, thresholds: list[tuple[str, float | None, float | None]] | None = None, text_col: str = "text") -> DataFrame:
    """The rows that the rules keep, columns as they were. Each row is judged by its own text, whatever its id; no shuffle."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    kept = quality_rules(held, thresholds, "row", "text").where("kept")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
