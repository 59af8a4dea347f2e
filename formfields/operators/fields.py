"""Field values: regions, value windows, best lines, candidates, choice, validation and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.filters import ADDRESS_WORDS, TYPE_BLEED, accepted, field_filter, without_prefixes
from ..functions.text import PLATE, behind, cleaned, collapsed, folded, is_mixed, is_run, null_if_blank, validated, vin_in_context
from .anchors import center_in
from .brands import canonical_brands
from .words import assemble_lines


def clipped(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> tuple[Column, Column, Column, Column]:
    """A box moved into the page: its corner within, sizes one or more and not beyond the page's edge."""
    cx = F.greatest(F.lit(0), F.least(x, width - 1))
    cy = F.greatest(F.lit(0), F.least(y, height - 1))
    return cx, cy, F.greatest(F.lit(1), F.least(w, width - cx)), F.greatest(F.lit(1), F.least(h, height - cy))


def boxed(df: DataFrame, keep: list[str], x: Column, y: Column, w: Column, h: Column) -> DataFrame:
    cx, cy, cw, ch = clipped(x, y, w, h, F.col("doc_w"), F.col("doc_h"))
    return df.select(*keep, cx.alias("rx"), cy.alias("ry"), cw.alias("rw"), ch.alias("rh"))


def part(share: str, whole: str) -> Column:
    return (F.col(share) * F.col(whole)).cast("int")


def roi_cells() -> tuple[Column, tuple[Column, Column, Column, Column]]:
    """Whether a page and rule (with its anchor's box ax, ay, aw, ah, or nulls) have a region, and its box before it is moved into the page."""
    by_anchor = F.col("ax").isNotNull() & F.col("dx").isNotNull()
    pick = lambda a, b: F.when(by_anchor, a).otherwise(b)
    cells = (
        pick(F.col("ax") + part("dx", "doc_w"), part("fx", "doc_w")), pick(F.col("ay") + part("dy", "doc_h"), part("fy", "doc_h")),
        pick(F.greatest(F.lit(1), part("dw", "doc_w")), F.greatest(F.lit(1), part("fw", "doc_w"))), pick(F.greatest(F.lit(1), part("dh", "doc_h")), F.greatest(F.lit(1), part("fh", "doc_h"))),
    )
    return by_anchor | F.col("fx").isNotNull(), cells


def window_cells() -> tuple[Column, Column, Column, Column]:
    """Where the value of a label is looked for, before the box is moved into the page: to the right of the label, or below it."""
    sized = lambda a, b, whole: ((F.col(b) + F.col(a)) * F.col(whole)).cast("int")
    right = F.col("direction") == "right"
    pick = lambda a, b: F.when(right, a).otherwise(b)
    across = ((F.col("mr") - F.col("ml")) * F.col("doc_w")).cast("int")
    down = ((F.col("mb") - F.col("mt")) * F.col("doc_h")).cast("int")
    return (
        pick(F.col("ax") + F.col("aw") + part("ml", "doc_w"), F.col("ax") - part("ml", "doc_w")), pick(F.col("ay") - part("mt", "doc_h"), F.col("ay") + F.col("ah") + part("mt", "doc_h")),
        F.greatest(F.lit(1), pick(across, F.col("aw") + sized("ml", "mr", "doc_w"))), F.greatest(F.lit(1), pick(F.col("ah") + sized("mt", "mb", "doc_h"), down)),
    )


def resolve_rois(pages: DataFrame, rules: DataFrame, anchors: DataFrame) -> DataFrame:
    """The region of each page and field: the anchor's box moved by the rule's offset, else the rule's fallback, else no row."""
    box = F.struct("ax", "ay", "aw", "ah")
    found = anchors.groupBy("page_id").agg(F.collect_list(F.struct("anchor", box.alias("box"))).alias("labels"))
    # A row a page up to here, so that nothing else is shuffled; an anchor with several boxes gives a region for each.
    every = pages.join(found, "page_id", "left").crossJoin(F.broadcast(rules)).withColumn("label", F.explode_outer(F.filter("labels", lambda l: l["anchor"] == F.col("anchor"))))
    held, cells = roi_cells()
    return boxed(every.select("*", "label.box.*").where(held), ["page_id", "field"], *cells)


def value_windows(pages: DataFrame, rules: DataFrame, anchors: DataFrame) -> DataFrame:
    """Where the value of each anchor found is looked for: a box to the right of the label, or below it."""
    met = anchors.join(F.broadcast(rules), "anchor").join(pages, "page_id")
    return boxed(met, ["page_id", "field", "direction", "ax", "ay", "aw", "ah"], *window_cells())


def words_in(words: DataFrame, regions: DataFrame) -> DataFrame:
    """Words whose centre lies in a region of their page, with that region's columns."""
    return words.join(regions, "page_id").where(center_in("x", "y", "w", "h", F.col("rx"), F.col("ry"), F.col("rw"), F.col("rh")))


def quality(text: Column) -> Column:
    """How much a line looks like a value: its longest token, five more for mixed tokens, letters and digits."""
    tokens = F.regexp_extract_all(F.upper(text), F.lit("([A-Z0-9]+)"), 1)
    longest = F.coalesce(F.array_max(F.transform(tokens, F.length)), F.lit(0))
    mixed = F.exists(tokens, lambda t: F.rlike(t, F.lit("[A-Z]")) & F.rlike(t, F.lit("[0-9]")))
    letters, digits = F.regexp_count(F.upper(text), F.lit("[A-Z]")), F.regexp_count(text, F.lit("[0-9]"))
    return longest + F.when(mixed, 5).otherwise(0) + F.floor(F.least(letters, F.lit(8)) / 3) + F.floor(F.least(digits, F.lit(8)) / 3)


def best_lines(words: DataFrame, windows: DataFrame) -> DataFrame:
    """The best plausible line of each value window, by the window's direction."""
    keys = ["field", "direction", "ax", "ay", "aw", "ah"]
    lines = assemble_lines(words_in(words, windows), *keys).where(F.regexp_count(F.upper("text"), F.lit("[A-Z0-9]")) >= 2)
    q = quality(F.col("text"))
    bottom, right = F.col("ay") + F.col("ah"), F.col("ax") + F.col("aw")
    below = F.col("direction") != "right"
    pooled = lines.withColumn("front", F.when(below, F.col("y") >= bottom - 4).otherwise(F.col("x") >= right - 4))
    page_field = Window.partitionBy("page_id", "field")
    pool = pooled.withColumn("any_front", F.max("front").over(page_field)).where("front OR NOT any_front")
    down = F.abs(F.col("y") - bottom) - 2.0 * q
    along = F.abs(F.col("y") + F.col("h") / 2 - F.col("ay") - F.col("ah") / 2) + 0.35 * F.greatest(F.lit(0), right - F.col("x")) - 2.5 * q
    ranked = pool.withColumn("rank_score", F.when(below, down).otherwise(along).cast("double"))
    order = page_field.orderBy("rank_score", F.desc("avg_conf"), "x", "y", "line_num")
    return ranked.withColumn("rn", F.row_number().over(order)).where("rn = 1").select("page_id", "field", F.when(below, "anchor_below_line").otherwise("anchor_right_line").alias("method"), F.col("text").alias("raw"), "x", "y", "w", "h", "rank_score")


def best_roi_lines(words: DataFrame, rois: DataFrame) -> DataFrame:
    """The line of each region nearest to its middle height."""
    lines = assemble_lines(words_in(words, rois), "field", "rx", "ry", "rw", "rh")
    order = Window.partitionBy("page_id", "field").orderBy(F.abs(F.col("y") + F.col("h") / 2 - F.col("ry") - F.col("rh") / 2), F.desc("avg_conf"), "x", "y", "line_num")
    return lines.withColumn("rn", F.row_number().over(order)).where("rn = 1").select("page_id", "field", F.lit("roi_line").alias("method"), F.col("text").alias("raw"), "x", "y", "w", "h")


def score_of(strategy: Column, value: Column) -> Column:
    """How well a cleaned value fits its strategy."""
    size = lambda c: F.coalesce(F.length(c), F.lit(0))
    pure = F.regexp_replace(value, "[^A-Z0-9]", "")
    words, parts = F.regexp_extract_all(value, F.lit("([A-Z0-9]+)"), 1), F.regexp_extract_all(value, F.lit("([A-Z0-9.-]+)"), 1)
    summed = lambda items, most, longest: F.aggregate(F.slice(items, 1, most), F.lit(0), lambda a, w: a + F.least(F.length(w), F.lit(longest)))
    labels = F.when(F.rlike(value, F.lit("\\b(?:SOYADI|ADI|TICARI|UNVAN|ADRES|NOTER)\\b")), 12).otherwise(0)
    owner = summed(F.filter(words, lambda w: F.rlike(w, F.lit("[A-Z]"))), 6, 1 << 20) - labels
    bonus = lambda mixed, n: F.when(mixed, n).otherwise(0)
    # One run of capitals and digits is its only word.
    run = is_run(value)
    own = F.when(F.rlike(value, F.lit("[A-Z]")), F.length(value)).otherwise(0) - labels
    return F.coalesce(
        F.when(value.isNull(), 0)
        .when(strategy == "plate", size(pure) + F.when(F.rlike(pure, F.lit(PLATE)), 12).otherwise(0))
        .when(strategy == "date", F.when(F.rlike(value, F.lit("^[0-9]{2}/[0-9]{2}/[0-9]{4}$")), 100).otherwise(0))
        .when(strategy == "alnum_upper", size(value) + bonus(is_mixed(value), 8)).when(strategy == "alnum_hyphen_upper", size(pure) + bonus(is_mixed(pure), 8))
        .when(strategy == "text_upper", F.when(run, F.length(value) + bonus(is_mixed(value), 4)).otherwise(F.coalesce(F.array_max(F.transform(words, F.length)), F.lit(0)) + bonus(F.exists(words, is_mixed), 4)))
        .when(strategy == "owner_text", F.greatest(F.lit(0), F.when(run, own).otherwise(owner)))
        .when(strategy == "vehicle_type", F.when(run, F.least(F.length(value), F.lit(12)) + bonus(is_mixed(value), 8)).otherwise(F.when(F.size(parts) > 0, summed(parts, 4, 12) + bonus(F.exists(parts, is_mixed), 8)))).otherwise(size(value)),
        F.lit(0),
    ).cast("int")


RULE_COLUMNS = ["field", "strategy", "threshold", "force_method", "min_len", "prefer_mixed", "prefixes"]


def with_rules(rows: DataFrame, rules: DataFrame, *columns: str) -> DataFrame:
    """rows (field, ...) with columns of their field's rule. Where rules come in several sets (rule_set), the rows' page_id is a struct that names the set."""
    if "rule_set" not in rules.columns:
        return rows.join(F.broadcast(rules.select("field", *columns)), "field")
    held = rules.select("rule_set", "field", *columns)
    return rows.withColumn("rule_set", F.col("page_id.rule_set")).join(F.broadcast(held), ["rule_set", "field"]).drop("rule_set")


def standardize(candidates: DataFrame, rules: DataFrame) -> DataFrame:
    """Candidates (field, raw, ...) with `cleaned` (by their field's strategy, without prefixes), its score, and `value`, what the field's filter leaves of it."""
    met = with_rules(candidates, rules, *RULE_COLUMNS[1:])
    # Each step reads what the one before has made; as one expression they would be repeated hundreds of times over.
    tidy = met.withColumn("tidy", F.when(is_run(F.col("raw")), F.col("raw")).otherwise(collapsed(F.col("raw"))))
    first = behind(tidy, first=cleaned(F.col("strategy"), F.col("tidy"))).drop("tidy")
    stripped = behind(first, stripped=without_prefixes(F.col("first"), F.col("prefixes"))).drop("first")
    kept = stripped.withColumn("cleaned", accepted(F.col("stripped"), F.col("min_len"), F.col("prefer_mixed"))).drop("stripped")
    return canonical_brands(behind(kept, score=score_of(F.col("strategy"), F.col("cleaned")), value=field_filter(F.col("field"), F.col("cleaned"))))


def best_candidates(scored: DataFrame) -> DataFrame:
    """One candidate of each page and field: the forced method first, then score, priority and order of arrival."""
    able = scored.where("value IS NOT NULL AND (threshold <= 0 OR score >= threshold)")
    order = Window.partitionBy("page_id", "field").orderBy(F.desc((F.col("method") == F.col("force_method")).cast("int")), F.desc("score"), F.desc("priority"), "cand_no")
    return able.withColumn("rn", F.row_number().over(order)).where("rn = 1").select("page_id", "field", "value", "raw", "method", F.col("score").alias("confidence_score"))


# The tails of vehicle types that look like a plate.
TYPE_TAIL = "(DCI|TDI|HDI|CDI|VVT|TSI|OIL|DIZEL|DIESEL)[0-9]{1,3}$"


def plate_candidates(words: DataFrame, pages: DataFrame, rois: DataFrame) -> DataFrame:
    """page_id, field, method, raw, value and score of the best plate among one to four tokens in a row on a line.

    Words in the upper left part of the page count, by the plate's region; nearer to the region is better. Pages
    without a plate region have none.
    """
    sized = words.join(rois.where("field = 'plate'").select("page_id", "rx", "ry", "rw", "rh"), "page_id").join(pages, "page_id")
    lowest = F.least(F.col("doc_h"), F.greatest(F.col("ry") + 2 * F.col("rh"), (F.col("doc_h") * 0.46).cast("int")))
    scoped = sized.where((F.col("y") + F.col("h") / 2 <= lowest) & (F.col("x") + F.col("w") / 2 <= (F.col("doc_w") * 0.68).cast("int")) & (F.col("conf") >= 10))
    place = ["page_id", "doc_w", "doc_h", "rx", "ry", "rw", "rh"]
    tokens = scoped.select(*place, "block_num", "par_num", "line_num", "word_no", "x", "y", "w", "h", F.posexplode(F.regexp_extract_all(folded(F.col("text")), F.lit("([A-Z0-9]+)"), 1)).alias("tok_no", "token"))
    line = Window.partitionBy("page_id", "block_num", "par_num", "line_num").orderBy("x", "word_no", "tok_no")
    following = tokens.withColumn("ts", F.collect_list(F.struct("token", "x", "y", "w", "h")).over(line.rowsBetween(0, 3)))
    runs = following.select(*place, "word_no", "tok_no", "ts", F.explode(F.sequence(F.lit(1), F.size("ts"))).alias("n")).select(*place, "word_no", "tok_no", "n", F.slice("ts", 1, F.col("n")).alias("ts"))
    plates = runs.withColumn("raw", F.array_join(F.transform("ts", lambda t: t["token"]), "")).where(F.rlike("raw", F.lit(PLATE)))
    low = lambda c: F.array_min(F.transform("ts", lambda t: t[c]))
    high = lambda c, size: F.array_max(F.transform("ts", lambda t: t[c] + t[size]))
    bx, by, bw, bh = clipped(low("x"), low("y"), high("x", "w") - low("x"), high("y", "h") - low("y"), F.col("doc_w"), F.col("doc_h"))
    boxed_runs = plates.select("*", bx.alias("bx"), by.alias("by"), bw.alias("bw"), bh.alias("bh"))
    across = F.abs(F.col("bx") + F.col("bw") / 2 - F.col("rx") - F.col("rw") / 2) / F.greatest(F.lit(1), "doc_w")
    down = F.abs(F.col("by") + F.col("bh") / 2 - F.col("ry") - F.col("rh") / 2) / F.greatest(F.lit(1), "doc_h")
    score = score_of(F.lit("plate"), F.col("raw")) + 12 - F.rint(10 * (across + down)).cast("int") - F.when(F.rlike("raw", F.lit(TYPE_TAIL)), 12).otherwise(0)
    order = Window.partitionBy("page_id").orderBy(F.desc("score"), "by", "bx", "word_no", "tok_no", "n")
    best = boxed_runs.withColumn("score", score).withColumn("rn", F.row_number().over(order)).where("rn = 1")
    return best.select("page_id", F.lit("plate").alias("field"), F.lit("semantic_plate_page_words").alias("method"), "raw", F.col("raw").alias("value"), "score")


def chosen(scored: DataFrame, pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, field, value, raw, method, confidence_score and low_confidence for every page and field: the best candidate, or none."""
    best = best_candidates(scored)
    every = pages.select("page_id").crossJoin(F.broadcast(rules.select("field", "threshold"))).join(best, ["page_id", "field"], "left")
    return every.select("page_id", "field", "value", "raw", F.coalesce("method", F.lit("empty_fallback")).alias("method"), F.coalesce("confidence_score", F.lit(0)).alias("confidence_score"), F.coalesce(F.col("confidence_score") < F.col("threshold"), F.col("threshold") > 0).alias("low_confidence"))


def permitted(raw: Column, whitelist: Column) -> Column:
    """Text without the characters that a rule doesn't permit; a missing or empty list permits all."""
    kept = F.array_join(F.filter(F.split(raw, ""), lambda c: F.contains(whitelist, c)), "")
    return F.when(F.coalesce(whitelist, F.lit("")) == "", raw).otherwise(kept)


def crop_gate(fields: DataFrame, rules: DataFrame, mode: str = "fallback", margin: int = 0) -> DataFrame:
    """fields with `asked`, whether their region is to be read again: none (disabled), all that have a rule (always), or those without a value or with a score near the threshold."""
    sets = ["rule_set"] if "rule_set" in rules.columns else []
    held = rules.select(*sets, "field", "threshold", F.lit(True).alias("ruled"))
    rows = fields.withColumn("rule_set", F.col("page_id.rule_set")) if sets else fields
    met = rows.join(F.broadcast(held), [*sets, "field"], "left")
    fragile = F.col("field").isin("owner_name", "owner_surname", "brand") & (F.col("confidence_score") < F.col("threshold") + max(2, margin))
    near = (F.col("threshold") > 0) & (F.col("confidence_score") < F.col("threshold") + max(0, margin))
    wanted = {"disabled": F.lit(False), "always": F.lit(True)}.get(mode, F.col("value").isNull() | fragile | near)
    return met.select(*fields.columns, F.coalesce(F.col("ruled") & wanted, F.lit(False)).alias("asked"))


def needs_crop_reading(fields: DataFrame, rules: DataFrame, mode: str = "fallback", margin: int = 0) -> DataFrame:
    """page_id and field of the regions to read again."""
    return crop_gate(fields, rules, mode, margin).where("asked").select("page_id", "field")


def fix_vins(fields: DataFrame) -> DataFrame:
    """Fields whose chassis number is repaired by its context; the method says so."""
    read = behind(fields, fixed=F.when(F.col("field") == "chassis_no", vin_in_context(F.col("value"))))
    changed = F.coalesce(F.col("fixed") != F.regexp_replace(F.upper("value"), "[^A-Z0-9]", ""), F.lit(False))
    new = {"value": F.when(changed, F.col("fixed")).otherwise(F.col("value")), "method": F.when(changed, F.concat_ws("|", F.nullif("method", F.lit("")), F.lit("vin_char_fix_v28"))).otherwise(F.col("method"))}
    return read.select(*[new.get(c, F.col(c)).alias(c) for c in fields.columns], changed.alias("vin_char_fix_applied"))


def validate(fields: DataFrame) -> DataFrame:
    """Fields in their final form; a value that can't be one is NULL, with a reason."""
    fields = behind(fields, fixed=null_if_blank(validated(F.col("field"), F.col("value"))))
    fixed = F.col("fixed")
    lost = F.col("value").isNotNull() & fixed.isNull()
    reason = F.lit("postprocess_validation_failed")
    boxes = [c for c in ("roi", "value_box") if c in fields.columns]
    return fields.select("page_id", "field", fixed.alias("value"), "raw", *boxes, F.when(lost, reason).otherwise(F.col("method")).alias("method"), "confidence_score", (F.col("low_confidence") | lost).alias("low_confidence"), F.when(lost, reason).alias("abstain_reason"), (fixed.isNotNull() & ~fixed.eqNullSafe(F.col("value"))).alias("postprocess_applied"))


def asks_second_reader(least: int) -> Column:
    """Whether a row of fields is to be read again: no value, low confidence, an address read as an owner, labels read as a type, or a low score."""
    text = folded(F.col("value"))
    owner = F.col("field").isin("owner_name", "owner_surname")
    return F.coalesce(F.col("value").isNull() | F.col("low_confidence") | F.when(owner, F.rlike(text, F.lit(ADDRESS_WORDS))).otherwise(((F.col("field") == "type") & F.rlike(text, F.lit(TYPE_BLEED))) | (F.col("confidence_score") < least)), F.lit(False))


def needs_secondary(fields: DataFrame, least: int = 0) -> DataFrame:
    """page_id and field where a second reader is asked."""
    return fields.where(asks_second_reader(least)).select("page_id", "field")


def apply_secondary(fields: DataFrame, readings: DataFrame, rules: DataFrame, allowed: list[str] | None = None, least: int = 0, method: str = "glm_roi_fallback") -> DataFrame:
    """Fields with a second reader's values (page_id, field, raw) where one is asked (needs_secondary) and the field is allowed (default: all).

    A blank reading, or one with EMPTY_PATCH, empties the field for sure; one that cleans to nothing leaves it alone; else
    the cleaned reading replaces the value, the score is the larger of both and the low flag follows the reading's own.
    """
    raw = F.col("raw")
    if "whitelist" in rules.columns:
        readings, raw = with_rules(readings, rules, "whitelist"), permitted(raw, F.col("whitelist"))
    wanted = readings.select("page_id", "field", F.coalesce(collapsed(raw), F.lit("")).alias("raw"))
    if allowed is not None:
        wanted = wanted.where(F.col("field").isin(allowed))
    read = standardize(wanted, rules).select("page_id", "field", F.col("raw").alias("second"), F.col("value").alias("second_value"), score_of(F.col("strategy"), F.col("value")).alias("second_score"), "threshold")
    met = fields.join(read, ["page_id", "field"], "left").withColumn("second", F.when(asks_second_reader(least), F.col("second")))
    empty = F.col("second").isNotNull() & ((F.col("second") == "") | F.contains("second", F.lit("EMPTY_PATCH")))
    taken = F.col("second").isNotNull() & ~empty & F.col("second_value").isNotNull()
    pick = lambda when_empty, when_taken, else_: F.when(empty, when_empty).when(taken, when_taken).otherwise(else_)
    return met.select(
        "page_id", "field", pick(F.lit(None), F.col("second_value"), F.col("value")).alias("value"),
        pick(F.when(F.contains("second", F.lit("EMPTY_PATCH")), "").otherwise(F.col("second")), F.col("second"), F.col("raw")).alias("raw"), pick(F.lit(method), F.lit(method), F.col("method")).alias("method"),
        pick(F.lit(100), F.greatest("second_score", "confidence_score"), F.col("confidence_score")).alias("confidence_score"),
        pick(F.lit(False), (F.col("threshold") > 0) & (F.col("second_score") < F.col("threshold")), F.col("low_confidence")).alias("low_confidence"), F.coalesce(empty | taken, F.lit(False)).alias("secondary_applied"),
        *(["roi", F.when(taken, F.col("roi")).otherwise(F.col("value_box")).alias("value_box")] if "roi" in fields.columns else []),
    )


def rule_effects(before: DataFrame, after: DataFrame, scored: DataFrame) -> DataFrame:
    """field, rule, n_in, n_changed, n_rejected and n_abstained: what cleaning, the field filter and the final form did to candidates and values."""
    count = lambda name, c: F.count_if(F.coalesce(c, F.lit(False))).alias(name)
    zero = F.lit(0).cast("long")
    clean = scored.groupBy("field").agg(F.count("*").alias("n_in"), count("n_changed", F.col("cleaned") != F.col("raw")), count("n_rejected", F.col("cleaned").isNull())).select("field", F.lit("clean").alias("rule"), "n_in", "n_changed", "n_rejected", zero.alias("n_abstained"))
    able = scored.where("cleaned IS NOT NULL").groupBy("field").agg(F.count("*").alias("n_in"), count("n_changed", F.col("value") != F.col("cleaned")), count("n_rejected", F.col("value").isNull())).select("field", F.lit("filter").alias("rule"), "n_in", "n_changed", "n_rejected", zero.alias("n_abstained"))
    met = after.select("page_id", "field", F.col("value").alias("now"), "abstain_reason").join(before.where("value IS NOT NULL").select("page_id", "field", "value"), ["page_id", "field"])
    final = met.groupBy("field").agg(F.count("*").alias("n_in"), count("n_changed", F.col("now") != F.col("value")), count("n_abstained", F.col("abstain_reason").isNotNull())).select("field", F.lit("final").alias("rule"), "n_in", "n_changed", zero.alias("n_rejected"), "n_abstained")
    return clean.unionByName(able).unionByName(final)


def compare_runs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per page and field of two runs: same, changed, only_left or only_right."""
    met = a.select("page_id", "field", F.col("value").alias("left_value")).join(b.select("page_id", "field", F.col("value").alias("right_value")), ["page_id", "field"], "full_outer")
    state = F.when(F.col("left_value").eqNullSafe(F.col("right_value")), "same").when(F.col("right_value").isNull(), "only_left").when(F.col("left_value").isNull(), "only_right").otherwise("changed")
    return met.withColumn("state", state)


def method_quality(fields: DataFrame, truth: DataFrame) -> DataFrame:
    """True and false positives and misses of each field and method."""
    met = fields.join(truth.select("page_id", "field", F.col("value").alias("true_value")), ["page_id", "field"], "left")
    return met.groupBy("field", "method").agg(F.count_if((F.col("value") == F.col("true_value"))).alias("tp"), F.count_if(F.col("value").isNotNull() & ~F.col("value").eqNullSafe(F.col("true_value"))).alias("fp"), F.count_if(F.col("value").isNull() & F.col("true_value").isNotNull()).alias("fn"))


def fill_rate(fields: DataFrame) -> DataFrame:
    return fields.groupBy("field").agg(F.count("*").alias("n"), F.count_if(F.col("value").isNotNull()).alias("n_filled"))


def fill_counts(fields: DataFrame) -> DataFrame:
    """Fields of each page, and how many of them are filled."""
    return fields.groupBy("page_id").agg(F.count("*").alias("n"), F.count_if(F.col("value").isNotNull() & (F.trim("value") != "")).alias("n_filled"))


def export_wide(fields: DataFrame, order: list[str]) -> DataFrame:
    """One row a page, a column for each field in a fixed order, '' for none."""
    wide = fields.groupBy("page_id").pivot("field", order).agg(F.first("value"))
    return wide.select("page_id", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in order])


def run_summary(runs: DataFrame) -> DataFrame:
    """Of each provider: runs, those that went well, their total and mean seconds."""
    return runs.groupBy("provider").agg(F.count("*").alias("n_runs"), F.count_if("ok").alias("n_ok"), F.round(F.sum(F.when(F.col("ok"), F.col("seconds"))), 3).alias("total_seconds"), F.round(F.avg(F.when(F.col("ok"), F.col("seconds"))), 3).alias("avg_seconds"))


def latency_stats(runs: DataFrame) -> DataFrame:
    return runs.groupBy("provider").agg(F.round(F.avg("seconds"), 3).alias("mean_s"), F.min("seconds").alias("min_s"), F.max("seconds").alias("max_s"))
