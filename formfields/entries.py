"""The registered queries of the form pipeline, and the SQL that says the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.filters import field_filter
from .functions.text import clean_date, clean_digits, clean_text, collapsed, fixed_date, standard_values, vin_in_context
from .operators import anchors as A
from .operators import fields as V
from .operators import layout as L
from .operators import page_rows as P
from .operators import second_pass as S
from .operators import words as W
from .operators.brands import canonical_brands
from .operators.candidates import page_regex_candidates
from .operators.extraction import choose, extract_fields, second_choice
from .operators.run import run_corpus, run_rule_sets
from .oracles import later_sql
from .plans.rules import ANCHORS, FIELD_ORDER, FIELDS, POST_CLEAN, anchor_rules, field_rules
from .scratch import shared_dir, written
from .sources import forms, tables
from .streaming import intake
from .value_oracles import DOC_WORDS, choice_sql, value_sql

Query = Callable[[SparkSession, str], DataFrame]
# Bytes of text of a partition of documents.
DOC_BYTES = 2 << 20


def found(spark: SparkSession, d: str, exact: bool) -> tuple[DataFrame, DataFrame]:
    """Words and labels. Words are made anew wherever they are read: that is less work than to hold them, and takes no room."""
    words = forms.form_words(spark, d)
    return words, A.match_anchors(words, anchor_rules(spark), exact)


def fields_of(spark: SparkSession, d: str) -> DataFrame:
    """The whole run: second readings of owners' names on every third page, rescues of engine numbers too."""
    words, anchors = found(spark, d, exact=False)
    return run_corpus(words, forms.form_pages(spark, d), field_rules(spark), anchors, second_readings(spark, d), with_engine_rescue=True)


def second_readings(spark: SparkSession, d: str) -> DataFrame:
    """A second reader's owner_name on every third page; on every ninth it finds nothing."""
    names = forms.form_truth(spark, d).where("field = 'owner_name' AND page_id % 3 = 0")
    return names.select("page_id", "field", F.when(F.col("page_id") % 9 == 0, "EMPTY_PATCH").otherwise(F.col("value")).alias("raw"))


def nothing_read(spark: SparkSession, d: str, field: str) -> DataFrame:
    """Pages whose field is empty, for the rescues."""
    return forms.form_pages(spark, d).select("page_id", F.lit(field).alias("field"), F.lit(None).cast("string").alias("value"), F.lit("").alias("raw"), F.lit("empty_fallback").alias("method"), F.lit(0).alias("confidence_score"), F.lit(True).alias("low_confidence"))


def q_form_truth(spark: SparkSession, d: str) -> DataFrame:
    return forms.form_truth(spark, d)


def q_form_words(spark: SparkSession, d: str) -> DataFrame:
    return forms.form_words(spark, d).select("page_id", "word_no", "text", "conf", "x", "y", "w", "h", "line_num")


def q_doc_words(spark: SparkSession, d: str) -> DataFrame:
    docs = spark.read.parquet(f"{d}/documents.parquet").select(F.col("doc_id").alias("page_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Texts are dealt out by document before they grow into words; a partition has some quarter of a million of these.
    lines = docs.repartition(size // DOC_BYTES + 1, "page_id").select("page_id", F.posexplode(F.split("text", "\n")).alias("line_no", "text"))
    return W.lines_to_words(lines.select("page_id", "line_no", "text", F.lit(0).alias("x"), (30 * F.col("line_no")).alias("y"), (10 * F.length("text")).alias("w"), F.lit(20).alias("h"), (40 + (F.col("page_id") * 7 + F.col("line_no") * 13) % 61).cast("double").alias("conf")))


def q_page_extents(spark: SparkSession, d: str) -> DataFrame:
    return W.page_extents(forms.form_words(spark, d))


def q_clean_words(spark: SparkSession, d: str) -> DataFrame:
    return W.clean_words(forms.form_words(spark, d), 75.0).groupBy("page_id").agg(F.count("*").alias("n_words"), F.avg("conf").alias("avg_conf"))


def q_assemble_lines(spark: SparkSession, d: str) -> DataFrame:
    return W.assemble_lines(forms.form_words(spark, d)).select("page_id", "line_num", "text", "x", "y", "w", "h", "avg_conf", "n_words")


def q_page_text(spark: SparkSession, d: str) -> DataFrame:
    return W.page_text(W.assemble_lines(forms.form_words(spark, d)))


def q_page_skew(spark: SparkSession, d: str) -> DataFrame:
    """Pages are tilted by their number: a word sinks or rises with its place across the page."""
    tilted = forms.form_words(spark, d).withColumn("y", F.col("y") + F.floor(F.col("x") * (F.col("page_id") % 7 - 3) / 50).cast("int"))
    return W.page_skew(tilted).select("page_id", F.round("skew_angle_deg", 6).alias("skew_angle_deg"))


def q_scope_words(spark: SparkSession, d: str) -> DataFrame:
    return A.scope_words(forms.form_words(spark, d), anchor_rules(spark)).select("page_id", "anchor", "word_no", "text")


def q_alias_overlap_probe(spark: SparkSession, d: str) -> DataFrame:
    words = forms.form_words(spark, d)
    return A.alias_overlap_probe(words, anchor_rules(spark), W.assemble_lines(words))


def q_exact_anchors(spark: SparkSession, d: str) -> DataFrame:
    return found(spark, d, exact=True)[1]


def q_match_anchors(spark: SparkSession, d: str) -> DataFrame:
    return found(spark, d, exact=False)[1]


def q_anchor_coverage(spark: SparkSession, d: str) -> DataFrame:
    _, anchors = found(spark, d, exact=True)
    return A.anchor_coverage(anchors, anchor_rules(spark), forms.form_pages(spark, d))


def q_resolve_rois(spark: SparkSession, d: str) -> DataFrame:
    _, anchors = found(spark, d, exact=True)
    return V.resolve_rois(forms.form_pages(spark, d), field_rules(spark), anchors)


def q_value_windows(spark: SparkSession, d: str) -> DataFrame:
    _, anchors = found(spark, d, exact=True)
    return V.value_windows(forms.form_pages(spark, d), field_rules(spark), anchors).select("page_id", "field", "rx", "ry", "rw", "rh")


def lines_beside(spark: SparkSession, d: str, exact: bool) -> DataFrame:
    """The best line of each label's window, found in pages as rows: page_id, field, method, raw. V.best_lines says the same word by word."""
    # All rules look beside their labels here, also those that would rather have the region's lines.
    lines = P.found_regions(forms.form_words(spark, d), forms.form_pages(spark, d), anchor_rules(spark), field_rules(spark).drop("prefer_anchor"), "beside", exact=exact)
    return lines.where("beside IS NOT NULL").select("page_id", "field", F.when(F.col("direction") != "right", "anchor_below_line").otherwise("anchor_right_line").alias("method"), F.col("beside.text").alias("raw"))


def q_best_lines(spark: SparkSession, d: str) -> DataFrame:
    return lines_beside(spark, d, exact=False)


def q_best_lines_exact(spark: SparkSession, d: str) -> DataFrame:
    """The lines beside labels that equal an alias."""
    return lines_beside(spark, d, exact=True)


def q_roi_lines(spark: SparkSession, d: str) -> DataFrame:
    """The line in the middle of each region, found in pages as rows. V.best_roi_lines says the same word by word."""
    lines = P.found_regions(forms.form_words(spark, d), forms.form_pages(spark, d), anchor_rules(spark), field_rules(spark), "within", exact=True)
    return lines.select("page_id", "field", F.lit("roi_line").alias("method"), F.col("within.text").alias("raw"))


def q_line_quality(spark: SparkSession, d: str) -> DataFrame:
    """True and false values and misses of lines taken as they are."""
    lines = q_best_lines_exact(spark, d).select("page_id", "field", "method", F.col("raw").alias("value"))
    return V.method_quality(lines, forms.form_truth(spark, d))


def q_fill_counts(spark: SparkSession, d: str) -> DataFrame:
    """Filled fields of each page where some have been lost."""
    return V.fill_counts(forms.form_truth(spark, d).withColumn("value", F.when((F.col("page_id") * 31 + F.length("value")) % 5 > 0, F.col("value"))))


def q_clean_dates(spark: SparkSession, d: str) -> DataFrame:
    rows = forms.form_truth(spark, d).where("field LIKE '%date'").withColumn("raw", F.when(F.col("page_id") % 2 == 0, F.replace("value", F.lit("/"), F.lit("."))).otherwise(F.concat(F.lit("TARIH: "), "value")))
    return rows.select("page_id", "field", clean_date(F.col("raw")).alias("cleaned"), fixed_date(F.col("raw")).alias("fixed"))


def q_clean_digits(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/documents.parquet")
    return rows.select("doc_id", clean_digits(F.coalesce("text", F.lit(""))).alias("digits"))


def q_extract_fields(spark: SparkSession, d: str) -> DataFrame:
    words, anchors = found(spark, d, exact=False)
    return extract_fields(words, forms.form_pages(spark, d), field_rules(spark), anchors)


def q_run_corpus(spark: SparkSession, d: str) -> DataFrame:
    return fields_of(spark, d)


def q_rule_effects(spark: SparkSession, d: str) -> DataFrame:
    # Read for the brands and for all candidates.
    lines = written(lines_beside(spark, d, exact=True), "lines").select("*", F.lit(4).alias("priority"), F.lit(3).alias("cand_no"))
    # Read for each of the rules, and by the choice: written once, else all would be found and cleaned again each time.
    scored = written(V.standardize(lines, field_rules(spark)).select("page_id", "field", "method", "raw", "priority", "cand_no", "cleaned", "score", "value", "threshold", "force_method"), "scored")
    before = V.chosen(scored, forms.form_pages(spark, d), field_rules(spark))
    return V.rule_effects(before, V.validate(before), scored)


def q_page_regex(spark: SparkSession, d: str) -> DataFrame:
    """Patterns for the pages, every third, whose labels are taken as not found."""
    pages = A.labelled_texts(forms.form_words(spark, d), anchor_rules(spark))
    taken = F.when(F.col("page_id") % 3 > 0, F.col("found")).otherwise(F.array().cast("array<string>"))
    return page_regex_candidates(pages.withColumn("found", taken), field_rules(spark)).select("page_id", "field", "method", "raw")


def q_region_text(spark: SparkSession, d: str) -> DataFrame:
    """The words inside each region, found in pages as rows. region_words says the same word by word."""
    lines = P.found_regions(forms.form_words(spark, d), forms.form_pages(spark, d), anchor_rules(spark), field_rules(spark), "inside", exact=True)
    return lines.select("page_id", "field", collapsed(F.col("inside.text")).alias("text"))


def q_second_pass(spark: SparkSession, d: str) -> DataFrame:
    """All ten fields of the second pass, as if none had been read before."""
    words = forms.form_words(spark, d)
    least = S.LEAST | S.OPTIONAL
    return S.second_pass_best(S.second_pass_candidates(words, forms.form_pages(spark, d), list(least)), least).select("page_id", "field", "value", "raw", "method", F.round("score", 4).alias("score"))


def q_serial_rescue(spark: SparkSession, d: str) -> DataFrame:
    words = forms.form_words(spark, d)
    return S.serial_rescue(words, forms.form_pages(spark, d), nothing_read(spark, d, "serial_no")).select("page_id", "value", "method", "confidence_score", "low_confidence")


def q_engine_rescue(spark: SparkSession, d: str) -> DataFrame:
    words = forms.form_words(spark, d)
    return S.engine_rescue(words, forms.form_pages(spark, d), nothing_read(spark, d, "engine_no")).select("page_id", "value", "method", "confidence_score", "low_confidence")


def q_vin_fix(spark: SparkSession, d: str) -> DataFrame:
    """Chassis numbers with characters that are often misread, repaired by their neighbours."""
    rows = forms.form_truth(spark, d).where("field = 'chassis_no'")
    misread = F.concat(F.lit("VE"), F.when(F.col("page_id") % 2 == 0, "I").otherwise("1"), F.substring("value", 4, 1), F.when(F.col("page_id") % 3 == 0, "8N5T").otherwise("5A8"), F.substring("value", 5, 10))
    return rows.select("page_id", vin_in_context(misread).alias("value"))


def q_validate_fields(spark: SparkSession, d: str) -> DataFrame:
    """Final forms of values with what is wrong with some of them."""
    rows = forms.form_truth(spark, d).withColumn("value", F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("NO "), "value")).when(F.col("page_id") % 4 == 1, F.substring("value", 1, 6)).otherwise(F.col("value")))
    fields = rows.where("field IN ('model_year', 'tax_or_id_no', 'serial_no', 'inspection_date', 'engine_no')").select("page_id", "field", "value", F.col("value").alias("raw"), F.lit("roi_line").alias("method"), F.lit(9).alias("confidence_score"), F.lit(False).alias("low_confidence"))
    return V.validate(fields).select("page_id", "field", "value", "method", "low_confidence", "abstain_reason", "postprocess_applied")


def q_exemplars(spark: SparkSession, d: str) -> DataFrame:
    words = forms.form_words(spark, d)
    images = forms.form_pages(spark, d).select("page_id", (2 * F.col("doc_w")).alias("image_w"), (2 * F.col("doc_h")).alias("image_h"))
    return A.exemplars(words, images, 65.0)


def q_exemplar_report(spark: SparkSession, d: str) -> DataFrame:
    return A.exemplar_report(q_exemplars(spark, d).where("page_id % 3 > 0"), anchor_rules(spark))


def q_page_coverage(spark: SparkSession, d: str) -> DataFrame:
    _, anchors = found(spark, d, exact=True)
    return A.page_coverage(anchors, anchor_rules(spark), forms.form_pages(spark, d))


def q_anchor_debug(spark: SparkSession, d: str) -> DataFrame:
    return A.anchor_debug(forms.form_words(spark, d), anchor_rules(spark))


def q_words_csv(spark: SparkSession, d: str) -> DataFrame:
    words = forms.form_words(spark, d)
    return tables.words_table(words, forms.form_pages(spark, d))


def q_payload_words(spark: SparkSession, d: str) -> DataFrame:
    return W.payload_to_words(forms.form_payloads(spark, d)).select("page_id", "word_no", "text", F.round("conf", 6).alias("conf"), "x", "y", "w", "h", "line_num")


def q_payload_text(spark: SparkSession, d: str) -> DataFrame:
    return W.payload_text(forms.form_payloads(spark, d))


def q_labelled_sections(spark: SparkSession, d: str) -> DataFrame:
    return L.labelled_sections(forms.form_markup(spark, d))


def q_result_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the truth, and back to the wide form."""
    truth = forms.form_truth(spark, d).select("page_id", "field", "value", F.col("value").alias("raw"), F.lit("truth").alias("method"), F.lit(100).alias("confidence_score"), F.lit(False).alias("low_confidence"))
    return tables.wide_results(tables.to_documents(truth), FIELD_ORDER)


def q_method_quality(spark: SparkSession, d: str) -> DataFrame:
    return V.method_quality(fields_of(spark, d), forms.form_truth(spark, d))


def q_fill_rate(spark: SparkSession, d: str) -> DataFrame:
    return V.fill_rate(fields_of(spark, d))


def q_run_corpus_wide(spark: SparkSession, d: str) -> DataFrame:
    return V.export_wide(fields_of(spark, d), FIELD_ORDER)


def q_export_wide(spark: SparkSession, d: str) -> DataFrame:
    return V.export_wide(forms.form_truth(spark, d), FIELD_ORDER)


def q_compare_runs(spark: SparkSession, d: str) -> DataFrame:
    truth = forms.form_truth(spark, d)
    other = truth.where("NOT (page_id % 7 = 3 AND field = 'brand')").withColumn("value", F.when((F.col("page_id") % 5 == 0) & (F.col("field") == "type"), F.lower("value")).otherwise(F.col("value")))
    return V.compare_runs(truth, other).groupBy("field", "state").agg(F.count("*").alias("n"))


def runs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet").select(F.col("event_id").alias("run_id"), F.col("user_id").alias("image"), F.col("event_type").alias("provider"), (F.col("event_type") != "error").alias("ok"), F.col("value").alias("seconds"))


def q_run_summary(spark: SparkSession, d: str) -> DataFrame:
    return V.run_summary(runs(spark, d))


def q_latency_stats(spark: SparkSession, d: str) -> DataFrame:
    return V.latency_stats(runs(spark, d))


def q_markup_text(spark: SparkSession, d: str) -> DataFrame:
    return W.markup_to_text(spark.read.parquet(f"{d}/pages.parquet"))


def q_line_boxes(spark: SparkSession, d: str) -> DataFrame:
    """The lines beside labels and in the middle of regions, found in pages as rows, with the region and the line's own box."""
    lines = P.found_regions(forms.form_words(spark, d), forms.form_pages(spark, d), anchor_rules(spark), field_rules(spark), "beside", "within", exact=True)
    beside = F.struct(F.when(F.col("direction") != "right", "anchor_below_line").otherwise("anchor_right_line").alias("method"), F.col("beside").alias("line"))
    both = F.inline(F.array(beside, F.struct(F.lit("roi_line").alias("method"), F.col("within").alias("line"))))
    every = lines.select("page_id", "field", "roi", "doc_w", "doc_h", both).where("line IS NOT NULL").withColumn("box", P.fitted(F.col("line")))
    return every.select("page_id", "field", "method", F.col("line.text").alias("raw"), *[F.col(f"roi.{c}").alias(f"roi_{c}") for c in "xywh"], *[F.col(f"box.{c}").alias(c) for c in "xywh"])


def first_choice(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Scored candidates of two fields of digits, some missing and some cut short, and what is chosen of them."""
    rows = forms.form_truth(spark, d).where("field IN ('model_year', 'tax_or_id_no')").join(F.broadcast(field_rules(spark).select("field", "threshold", "force_method")), "field")
    value = F.when(F.col("page_id") % 3 == 1, F.substring("value", 1, 2)).when(F.col("page_id") % 3 == 2, F.col("value"))
    box = F.struct(F.lit(10).alias("x"), F.lit(20).alias("y"), F.lit(300).alias("w"), F.lit(40).alias("h"))
    scored = rows.select("page_id", "field", box.alias("roi"), F.lit("roi_line").alias("method"), F.col("value").alias("raw"), F.lit(3).alias("priority"), F.lit(4).alias("cand_no"), value.alias("value"), F.coalesce(F.length(value), F.lit(0)).alias("score"), "threshold", "force_method", box.alias("value_box"))
    return scored, choose(scored)


def q_crop_gate(spark: SparkSession, d: str) -> DataFrame:
    """The list of regions to read again."""
    return V.needs_crop_reading(first_choice(spark, d)[1], field_rules(spark), "fallback", 0)


def q_crop_choice(spark: SparkSession, d: str) -> DataFrame:
    """Fields chosen again with three readings of their crops, where the gate asks for them."""
    scored, first = first_choice(spark, d)
    truth = forms.form_truth(spark, d)
    variant = F.explode(F.array(F.lit("preprocessed"), F.lit("preprocessed_alt"), F.lit("raw"))).alias("variant")
    read = F.when(F.col("variant") == "raw", F.concat("value", F.lit(" X9"))).when((F.col("variant") == "preprocessed") & (F.col("page_id") % 2 == 0), F.concat(F.lit("NO 1 "), "value")).otherwise("")
    crops = truth.select("page_id", "field", "value", variant).select("page_id", "field", "variant", read.alias("raw"))
    return second_choice(scored, first, crops, field_rules(spark)).select("page_id", "field", "value", "raw", "method", "confidence_score", "low_confidence")


def q_secondary_choice(spark: SparkSession, d: str) -> DataFrame:
    """A second reader's names, and its word that there is none, for the pages that ask for them."""
    names = forms.form_truth(spark, d).where("field = 'owner_name'")
    empty = F.col("page_id") % 3 == 0
    fields = names.select("page_id", "field", F.when(~empty, F.col("value")).alias("value"), F.col("value").alias("raw"), F.lit("roi_line").alias("method"), F.when(empty, 0).otherwise(F.length("value")).alias("confidence_score"), (empty | (F.col("page_id") % 3 == 1)).alias("low_confidence"))
    number = F.col("page_id") % 4
    readings = names.where(number < 3).select("page_id", "field", F.when(number == 0, "EMPTY_PATCH").when(number == 1, " ").otherwise(F.col("value")).alias("raw"))
    return V.apply_secondary(fields, readings, field_rules(spark))


def q_template_anchors(spark: SparkSession, d: str) -> DataFrame:
    """Serial labels by text, and by template hits on the pages that lack them."""
    _, anchors = found(spark, d, exact=True)
    pages = forms.form_truth(spark, d).where("field = 'plate'")
    hit = lambda file, shift, score: F.struct(F.lit(file).alias("template_file"), score.alias("score"), (F.lit(900) + shift).alias("x"), F.lit(830).alias("y"), F.lit(150).alias("w"), F.lit(24).alias("h"))
    score = F.lit(0.605) + F.col("page_id") % 7 / 100
    hits = pages.where("page_id % 5 = 4").select("page_id", F.lit("serial_label").alias("anchor"), F.inline(F.array(hit("b.png", 0, score), hit("a.png", 3, score), hit("c.png", 5, score - 0.01))))
    return A.merge_anchors(anchors, hits).where("anchor = 'serial_label'")


def q_brand_names(spark: SparkSession, d: str) -> DataFrame:
    """Brands as they are, with a number, after their label, and none."""
    rows = forms.form_truth(spark, d).where("field = 'brand'")
    number = F.col("page_id") % 4
    read = F.when(number == 1, F.concat("value", F.lit(" 15"))).when(number == 2, F.concat(F.lit("MARKASI "), "value")).when(number == 3, F.concat(F.lit("QQ"), F.col("page_id") % 7)).otherwise(F.col("value"))
    return canonical_brands(rows.select("page_id", "field", read.alias("value")))


def conversation_layouts(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as nested layouts: turns with a text, a note and marked items, and keys that hold no text."""
    nothing = F.lit(None).cast("string")
    turn = F.struct(
        "turn", F.lit("no text").alias("label"), F.col("text").alias("content"),
        F.struct(F.concat(F.lit("note "), "turn").alias("note"), F.array(F.struct(F.concat(F.lit("see "), F.col("turn") % 3).alias("md"), nothing.alias("other")), F.struct(nothing.alias("md"), F.concat(F.lit("note "), F.col("turn") - 1).alias("other"))).alias("items"), F.struct(F.lit("never").alias("text")).alias("page")).alias("extra"),
    )
    rows = spark.read.parquet(f"{d}/conversations.parquet").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    layout = F.struct(F.concat(F.lit("conversation "), "conv_id").alias("title"), F.lit(3).alias("score"), "turns")
    return rows.select(F.col("conv_id").alias("page_id"), F.to_json(layout).alias("json"))


def q_layout_json(spark: SparkSession, d: str) -> DataFrame:
    return L.flatten_json(conversation_layouts(spark, d))


def request_stream(spark: SparkSession, d: str) -> DataFrame:
    """Events as requests, read as a stream of files."""
    # A pattern, so that the table may be one file as well as a folder of files.
    rows = intake.stream_requests(spark, f"{d}/events.parque[t]", schema=spark.read.parquet(f"{d}/events.parquet").schema)
    return rows.select(F.col("event_id").alias("request_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("provider"), F.col("value").alias("latency_ms"))


def q_request_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The counters of a service after a stream of requests has been taken in."""
    at = f"{shared_dir(spark)}/requests-{uuid.uuid4().hex}"
    intake.run_metrics(request_stream(spark, d), f"{at}/out", f"{at}/checkpoint").awaitTermination()
    return intake.latest_metrics(spark, f"{at}/out").select("provider", "requests", "avg_latency_ms", "max_latency_ms")


def rule_set_rules(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Two sets as loaded rules: the one of record, and one that takes no lines beside labels."""
    anchors, fields = tables.rule_documents(ANCHORS, FIELDS, POST_CLEAN, "of_record")
    more_anchors, more_fields = tables.rule_documents(ANCHORS, FIELDS, POST_CLEAN, "regions_only")
    more_fields = [f | {"prefer_anchor": False} for f in more_fields]
    rows = lambda schema, found: spark.createDataFrame([tuple(r.get(c.split()[0]) for c in schema.split(", ")) + (k,) for k, r in enumerate(found)], schema + ", position int")
    loaded = tables.load_rules(rows(tables.ANCHOR_RULES, anchors + more_anchors), rows(tables.FIELD_RULES, fields + more_fields))
    return loaded[0], loaded[1]


def q_compare_rule_sets(spark: SparkSession, d: str) -> DataFrame:
    """What another rule set changes, by field: both run in one pass."""
    words = forms.form_words(spark, d)
    every = written(run_rule_sets(words, forms.form_pages(spark, d), *rule_set_rules(spark)), "rule-sets")
    of = lambda name: every.where(F.col("rule_set") == name)
    return V.compare_runs(of("of_record"), of("regions_only")).groupBy("field", "state").agg(F.count("*").alias("n"))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_run_corpus_wide(spark, sf_dir)


FILTERED = ("plate", "brand", "serial_no", "owner_surname", "owner_name", "type", "chassis_no", "tax_or_id_no", "inspection_date")


def q_standard_values(spark: SparkSession, d: str) -> DataFrame:
    """What each strategy makes of every line of every page."""
    return standard_values(W.line_texts(forms.form_words(spark, d)), "page_id", "line_num")


def q_field_filters(spark: SparkSession, d: str) -> DataFrame:
    """What the filters of nine fields leave of every line of every page; lines without a letter or digit are left out."""
    lines = W.line_texts(forms.form_words(spark, d)).select("page_id", "line_num", clean_text(F.col("text")).alias("plain")).where("plain <> ''")
    return lines.select("page_id", "line_num", *[field_filter(F.lit(f), F.col("plain")).alias(f) for f in FILTERED])


def q_field_choices(spark: SparkSession, d: str) -> DataFrame:
    """The choice among three readings of each value: scores that tie or fall short of the threshold, a forced method on every fifth page, readings that the filter took."""
    truth = forms.form_truth(spark, d).select("page_id", "field", "value", F.length("value").alias("n"))
    ways = F.array(*[F.struct(F.lit(k).alias("cand_no"), F.lit(m).alias("method"), F.lit(p).alias("priority")) for k, m, p in CHOICES])
    rows = truth.select("*", F.inline(ways))
    turn = F.col("page_id") + 3 * F.col("cand_no") + F.col("n")
    none = F.lit(None).cast(P.BOX)
    return choose(rows.select(
        "page_id", "field", none.alias("roi"), "method", F.concat("value", F.lit(" "), "method").alias("raw"), "priority", "cand_no", F.when(turn % 4 > 0, F.concat("value", F.lit("/"), "method")).alias("value"), (turn % 3 * 5).cast("int").alias("score"),
        (F.col("page_id") % 4 * 3).cast("int").alias("threshold"), F.when(F.col("page_id") % 5 == 0, "roi_line").alias("force_method"), none.alias("value_box"),
    )).select("page_id", "field", "value", "raw", "method", "confidence_score", "low_confidence")


# Readings of q_field_choices: order of arrival, method, priority; the last two have one priority.
CHOICES = [(1, "semantic_owner_roi_words", 5), (3, "anchor_right_line", 4), (4, "roi_line", 4)]


def queries() -> dict[str, Query]:
    return {name[2:]: f for name, f in globals().items() if name.startswith("q_")}


def values(rows: list[tuple]) -> str:
    one = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else str(v)
    return ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)


TRUTH = forms.TRUTH.replace("{orders}", "orders")
LINES = forms.LINES.replace("{orders}", "orders").replace("{{orders}}", "orders").replace("{orders}", "orders")
# Labels and values have three words at most, so the shares of a line's width need no recursion.
WORDS = f"""
lines AS (SELECT page_id, line_no, text, x, y, w, CAST(60 + (page_id * 7 + line_no * 13) % 40 AS DOUBLE) AS conf, string_split(text, ' ') AS p FROM ({LINES})),
shares AS (SELECT *, CASE WHEN len(p) = 1 THEN w ELSE greatest(1, CAST(round_even(w * length(p[1]) / CAST(length(replace(text, ' ', '')) AS DOUBLE), 0) AS INT)) END AS w1 FROM lines),
shares2 AS (SELECT *, CASE WHEN len(p) = 2 THEN greatest(1, w - w1) WHEN len(p) = 3 THEN greatest(1, CAST(round_even((w - w1) * length(p[2]) / CAST(length(p[2]) + length(p[3]) AS DOUBLE), 0) AS INT)) END AS w2 FROM shares),
cut AS (SELECT page_id, line_no, conf, y, unnest(p) AS text, unnest(range(1, len(p) + 1)) AS i, x, w, w1, w2 FROM shares2),
words AS (
  SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY y, wx, line_no, i) - 1 AS word_no, text, conf, wx AS x, y, ww AS w, 24 AS h, line_no AS line_num
  FROM (SELECT *, CASE i WHEN 1 THEN x WHEN 2 THEN x + w1 ELSE x + w1 + w2 END AS wx, CASE i WHEN 1 THEN w1 WHEN 2 THEN w2 ELSE greatest(1, w - w1 - w2) END AS ww FROM cut))
"""
ASSEMBLED = "joined AS (SELECT page_id, line_num, string_agg(text, ' ' ORDER BY x, word_no) AS text, min(x) AS x, min(y) AS y, max(x + w) - min(x) AS w, max(y + h) - min(y) AS h, avg(conf) AS avg_conf, count(*) AS n_words FROM words GROUP BY page_id, line_num)"
RULES = f"rules AS (SELECT * FROM (VALUES {values([(a, *r) for a, _, _, r in ANCHORS])}) t(anchor, rx, ry, rw, rh))"
EXTENTS = "ext AS (SELECT page_id, max(x + w) AS ext_w, max(y + h) AS ext_h FROM words GROUP BY page_id)"
SCOPED = """scoped AS (SELECT w.*, r.anchor FROM words w JOIN ext USING (page_id) JOIN rules r
  ON w.x + w.w / 2.0 BETWEEN trunc(rx * ext_w) AND trunc(rx * ext_w) + greatest(1, trunc(rw * ext_w)) AND w.y + w.h / 2.0 BETWEEN trunc(ry * ext_h) AND trunc(ry * ext_h) + greatest(1, trunc(rh * ext_h)))"""


def folded(text: str) -> str:
    return f"upper(translate({text}, 'ÇĞİÖŞÜÂÎÛçğıiöşüâîû', 'CGIOSUAIUCGIIOSUAIU'))"


ALIASES = f"aliases AS (SELECT *, trim(regexp_replace({folded('alias')}, '[^A-Z0-9 ]+', ' ', 'g')) AS norm FROM (VALUES {values([(a, k, s) for a, _, names, _ in ANCHORS for k, s in enumerate(names)])}) t(anchor, alias_no, alias))"
EXACT = f"""
normed AS (SELECT *, trim(regexp_replace({folded('text')}, '[^A-Z0-9 ]+', ' ', 'g')) AS norm FROM scoped),
ordered AS (SELECT *, row_number() OVER (PARTITION BY page_id, anchor ORDER BY word_no) AS q FROM normed WHERE norm <> ''),
runs AS (
  SELECT a.page_id, a.anchor, a.word_no, count(*) AS n, string_agg(b.norm, ' ' ORDER BY b.q) AS phrase, string_agg(b.norm, '' ORDER BY b.q) AS glued, min(b.x) AS ax, min(b.y) AS ay, max(b.x + b.w) - min(b.x) AS aw, max(b.y + b.h) - min(b.y) AS ah
  FROM ordered a JOIN (VALUES (1), (2), (3), (4)) k(size) ON true JOIN ordered b ON b.page_id = a.page_id AND b.anchor = a.anchor AND b.line_num = a.line_num AND b.q >= a.q AND b.q < a.q + k.size
  GROUP BY a.page_id, a.anchor, a.word_no, a.q, k.size HAVING count(*) = k.size),
hits AS (
  SELECT r.*, l.alias, l.alias_no, 0 AS kind FROM runs r JOIN aliases l ON l.anchor = r.anchor AND l.norm = r.phrase
  UNION ALL SELECT r.*, l.alias, l.alias_no, 1 FROM runs r JOIN aliases l ON l.anchor = r.anchor AND contains(l.norm, ' ') AND r.n <= 3 AND replace(l.norm, ' ', '') = r.glued),
anchors AS (SELECT page_id, anchor, alias, CAST(1.0 AS DOUBLE) AS score, ax, ay, aw, ah FROM hits QUALIFY row_number() OVER (PARTITION BY page_id, anchor ORDER BY alias_no, kind, CASE WHEN kind = 1 THEN n ELSE 0 END, word_no) = 1)
"""
FIELD_RULES = "field_rules AS (SELECT * FROM (VALUES " + values([(f, a, *map(float, o), *(map(float, b) if b else (None,) * 4), way, *map(float, m)) for f, a, o, b, way, m, *_ in FIELDS]) + ") t(field, anchor, dx, dy, dw, dh, fx, fy, fw, fh, direction, ml, mt, mr, mb))"
CHAIN = f"{WORDS}, {EXTENTS}, {RULES}, {SCOPED}, {ALIASES}, {EXACT}"
CLIP = "greatest(0, least(bx, 1599)) AS rx, greatest(0, least(by_, 999)) AS ry, greatest(1, least(bw, 1600 - greatest(0, least(bx, 1599)))) AS rw, greatest(1, least(bh, 1000 - greatest(0, least(by_, 999)))) AS rh"
part = lambda share, whole: f"CAST(trunc({share} * {whole}) AS BIGINT)"
ROIS = f"""SELECT page_id, field, {CLIP} FROM (
  SELECT p.page_id, f.field, CASE WHEN a.ax IS NOT NULL THEN a.ax + {part("dx", 1600)} ELSE {part("fx", 1600)} END AS bx, CASE WHEN a.ax IS NOT NULL THEN a.ay + {part("dy", 1000)} ELSE {part("fy", 1000)} END AS by_,
    greatest(1, CASE WHEN a.ax IS NOT NULL THEN {part("dw", 1600)} ELSE {part("fw", 1600)} END) AS bw, greatest(1, CASE WHEN a.ax IS NOT NULL THEN {part("dh", 1000)} ELSE {part("fh", 1000)} END) AS bh
  FROM (SELECT DISTINCT page_id FROM words) p CROSS JOIN field_rules f LEFT JOIN anchors a ON a.page_id = p.page_id AND a.anchor = f.anchor WHERE a.ax IS NOT NULL OR f.fx IS NOT NULL)"""
WINDOWS = f"""SELECT page_id, field, {CLIP} FROM (
  SELECT page_id, field, CASE WHEN direction = 'right' THEN ax + aw + {part("ml", 1600)} ELSE ax - {part("ml", 1600)} END AS bx, CASE WHEN direction = 'right' THEN ay - {part("mt", 1000)} ELSE ay + ah + {part("mt", 1000)} END AS by_,
    greatest(1, CASE WHEN direction = 'right' THEN {part("(mr - ml)", 1600)} ELSE aw + {part("(mr + ml)", 1600)} END) AS bw, greatest(1, CASE WHEN direction = 'right' THEN ah + {part("(mb + mt)", 1000)} ELSE {part("(mb - mt)", 1000)} END) AS bh
  FROM anchors JOIN field_rules USING (anchor))"""


def oracle_sql() -> dict[str, str]:
    runs = "runs AS (SELECT event_type AS provider, event_type <> 'error' AS ok, value AS seconds FROM events)"
    wide = ", ".join(f"coalesce(max(CASE WHEN field = '{f}' THEN value END), '') AS {f}" for f in FIELD_ORDER)
    return {
        "form_truth": f"SELECT page_id, field, value FROM ({TRUTH})",
        "doc_words": DOC_WORDS, "field_choices": choice_sql(TRUTH, values(CHOICES)),
        "form_words": f"WITH {WORDS} SELECT * FROM words",
        "page_extents": f"WITH {WORDS}, {EXTENTS} SELECT * FROM ext",
        "clean_words": f"WITH {WORDS} SELECT page_id, count(*) AS n_words, avg(conf) AS avg_conf FROM words WHERE conf >= 75 GROUP BY page_id",
        "assemble_lines": f"WITH {WORDS}, {ASSEMBLED} SELECT * FROM joined",
        "page_text": f"WITH {WORDS}, {ASSEMBLED} SELECT page_id, string_agg({folded('text')}, chr(10) ORDER BY y, x, line_num) AS text FROM joined GROUP BY page_id",
        "scope_words": f"WITH {WORDS}, {EXTENTS}, {RULES}, {SCOPED} SELECT page_id, anchor, word_no, text FROM scoped",
        "alias_overlap_probe": f"WITH {WORDS}, {ASSEMBLED}, {ALIASES}, t AS (SELECT DISTINCT page_id, line_num, x, y, unnest(string_split(trim(regexp_replace({folded('text')}, '[^A-Z0-9 ]+', ' ', 'g')), ' ')) AS token FROM joined), a AS (SELECT anchor, token, count(*) AS times FROM (SELECT anchor, unnest(string_split(norm, ' ')) AS token FROM aliases) GROUP BY ALL) SELECT page_id, anchor, line_num, CAST(sum(times) AS BIGINT) AS token_overlap, min(x) AS x, min(y) AS y FROM t JOIN a USING (token) GROUP BY page_id, anchor, line_num",
        "exact_anchors": f"WITH {CHAIN} SELECT * FROM anchors",
        "anchor_coverage": f"WITH {CHAIN} SELECT r.anchor, count(a.page_id) AS n_found, (SELECT count(DISTINCT page_id) FROM words) AS n_pages, count(a.page_id) / CAST((SELECT count(DISTINCT page_id) FROM words) AS DOUBLE) AS hit_rate FROM rules r LEFT JOIN anchors a USING (anchor) GROUP BY r.anchor",
        "resolve_rois": f"WITH {CHAIN}, {FIELD_RULES} {ROIS}",
        "value_windows": f"WITH {CHAIN}, {FIELD_RULES} {WINDOWS}",
        "clean_digits": "SELECT doc_id, coalesce((SELECT d FROM (SELECT unnest(regexp_extract_all(text, '[0-9]+')) AS d, unnest(range(1, len(regexp_extract_all(text, '[0-9]+')) + 1)) AS i) ORDER BY length(d) DESC, i LIMIT 1), '') AS digits FROM documents",
        "export_wide": f"SELECT page_id, {wide} FROM ({TRUTH}) GROUP BY page_id",
        "compare_runs": f"WITH t AS ({TRUTH}) SELECT field, CASE WHEN page_id % 7 = 3 AND field = 'brand' THEN 'only_left' WHEN page_id % 5 = 0 AND field = 'type' AND lower(value) <> value THEN 'changed' ELSE 'same' END AS state, count(*) AS n FROM t GROUP BY ALL",
        "run_summary": f"WITH {runs} SELECT provider, count(*) AS n_runs, count(*) FILTER (ok) AS n_ok, round(sum(seconds) FILTER (ok), 3) AS total_seconds, round(avg(seconds) FILTER (ok), 3) AS avg_seconds FROM runs GROUP BY provider",
        "latency_stats": f"WITH {runs} SELECT provider, round(avg(seconds), 3) AS mean_s, min(seconds) AS min_s, max(seconds) AS max_s FROM runs GROUP BY provider",
        "markup_text": """WITH l AS (SELECT page_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(html, chr(13), chr(10)), '<img[^>]*>', ' ', 'gi'), '</(tr|table|td)>', chr(10), 'gi'), '<br *\\/?>', chr(10), 'gi'), '<[^>]+>', ' ', 'g'), chr(10)), lambda t: trim(regexp_replace(t, '[ \\t\\f\\x0B]+', ' ', 'g'))), lambda t: regexp_matches(t, '[A-Za-z0-9ÇĞİÖŞÜçğıöşü]')) AS k FROM pages) SELECT page_id, unnest(range(0, len(k))) AS line_no, unnest(k) AS text FROM l""",
    } | value_sql(WORDS, ASSEMBLED, folded) | later_sql(TRUTH, WORDS, ASSEMBLED, CHAIN, EXTENTS, RULES, FIELD_RULES, ROIS, WINDOWS, folded, lambda c: f"trim(regexp_replace({folded(c)}, '[^A-Z0-9 ]+', ' ', 'g'))")
