"""A corpus pipeline of five stages; each is written as Parquet and reread before the next one.

Null and empty texts fail the quality rules. Texts are taken whole, however long; an empty table stays empty; columns
besides doc_id and text pass through as they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formfields.llm.common import scratch, shared_dir, table
from formfields.llm.decontamination import decontaminate
from formfields.llm.mixing import with_rates
from formfields.llm.ngram_join import one_of_each
from formfields.llm.quality_rules import keep_good
from formfields.llm.secrets import redact


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; each row is judged by its own text, also where its id is null or repeats."""
    return keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies. Rows with one id are one document; null ids stay."""
    return one_of_each(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; each row is judged by its own text."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each with the secrets of its own text masked; n_chars, where it is there and known, follows the new text."""
    masked = redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    length = F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return masked.withColumn("n_chars", length)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the rate at which to draw each, its tokens and domain posteriors; columns of those names give way.

    The quality rules have removed the poor documents, so good and toxic have targets and what is left of poor has none.
    """
    return with_rates(docs, table(spark, sf_dir, "labels"), TARGETS)


# Shares of the expected tokens of the domains that the last stage's input can meet.
TARGETS = {"good": 0.98, "toxic": 0.02}

STAGES = [
    ("quality_rules", keep_quality),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_copies),
    ("secret_scan", mask_secrets),
    ("mixing", mix_to_targets),
]

# Shingle components, string tiling and fitted models are beyond SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    at = f"{shared_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{at}/{k}-{name}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
