"""The registered queries of this subpackage, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, html_extraction, importance_resampling, lm_scoring, mixing, ngram_join, periodic_runs, quality_rules, secrets, token_counts, toxicity, url_filters, web_archive
from .common import shared_dir, table

VOCABULARY = "byte_bpe_50k.json"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "n_tiles", "longest_tile", "covered", "coverage")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    spans = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["s"], x["e"])), ",")
    return found.select("doc_id", "held_out", "score", "predicted", "n_toxic", spans.alias("spans"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), links=False)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op6_archive_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    at = f"{shared_dir(spark)}/archives-{uuid.uuid4().hex}"
    web_archive.write_arc(table(spark, sf_dir, "pages"), f"{at}/arc")
    web_archive.archive_to_warc(spark, f"{at}/arc", f"{at}/warc")
    return web_archive.read_warc(spark, f"{at}/warc", payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(table(spark, sf_dir, "documents"), scan=True)


def op8_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_main_text(table(spark, sf_dir, "pages"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def with_periods(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A document whose id's checksum ends in 0 repeats, from some word on, the words of a period drawn from the checksum."""
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"), rewrite=with_periods)
    best = F.expr("aggregate(runs, CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>), (a, r) -> IF(a IS NULL OR r.length * a.period > a.length * r.period, r, a))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's path names the document that it shows, whose label is the page's: bad where it is toxic or of low quality."""
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id AS number", "toxic = 1 OR quality = 0 AS bad")
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), labels, url_filters.URL_RULES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_decontamination, op2_token_counts, op3_toxicity, op4_ngram_join, op5_secret_scan, op6_archive_conversion, op7_deleted_interpolation, op8_soft_mixing, op9_page_differencing, op10_quality_rules, op11_importance_resampling, op12_periodic_runs, op13_url_filters)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    from .sql import OP4, OP5, OP6, OP10, OP11, OP12, OP13

    return {"op4_ngram_join": OP4, "op5_secret_scan": OP5, "op6_archive_conversion": OP6, "op10_quality_rules": OP10, "op11_importance_resampling": OP11, "op12_periodic_runs": OP12, "op13_url_filters": OP13}
