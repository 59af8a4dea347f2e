"""Incremental intake of word files: every micro-batch holds whole pages and goes through the batch plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

WORDS = "page_id long, word_no int, text string, conf double, x int, y int, w int, h int, block_num int, par_num int, line_num int"


def stream_words(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(WORDS).format(fmt).load(path)


def run_intake(words: DataFrame, plan: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Each batch's result is written under its batch number, so that a batch that runs again replaces itself."""

    def each(batch: DataFrame, number: int) -> None:
        plan(batch).write.mode("overwrite").parquet(f"{out}/batch_id={number}")

    return words.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


REQUESTS = "request_id long, ts timestamp, provider string, latency_ms double"


def running_metrics(requests: DataFrame) -> DataFrame:
    """Requests and mean latency so far (request_id, latency_ms)."""
    return requests.groupBy().agg(F.count("*").alias("requests"), F.round(F.avg("latency_ms"), 1).alias("avg_latency_ms"))


def provider_metrics(requests: DataFrame) -> DataFrame:
    """Requests, mean and largest latency, and the first and last request of each provider: of a table, or so far of a stream. The state is one row a provider."""
    return requests.groupBy("provider").agg(
        F.count("*").alias("requests"), F.round(F.avg("latency_ms"), 1).alias("avg_latency_ms"), F.max("latency_ms").alias("max_latency_ms"),
        F.min("ts").alias("first_at"), F.max("ts").alias("last_at"),
    )


def window_metrics(requests: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Requests and mean latency of each provider and window of time. On a stream a window is given out once, when the watermark (`late` behind the latest request) has passed it, and its state is let go."""
    timed = requests.withWatermark("ts", late) if requests.isStreaming else requests
    found = timed.groupBy("provider", F.window("ts", size).alias("w")).agg(F.count("*").alias("requests"), F.round(F.avg("latency_ms"), 1).alias("avg_latency_ms"))
    return found.select("provider", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "requests", "avg_latency_ms")


def stream_requests(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | StructType = REQUESTS, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(path)


def run_metrics(requests: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Counters that survive a restart: each batch writes the whole of provider_metrics so far (complete mode) in the place of the last.

    The counts are state of the stream, kept in its checkpoint; a run that starts from it goes on where the last stopped,
    and a batch that runs again writes the same.
    """
    def each(now: DataFrame, number: int) -> None:
        now.write.mode("overwrite").parquet(f"{out}/batch_id={number}")

    return provider_metrics(requests).writeStream.outputMode("complete").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_window_metrics(requests: DataFrame, out: str, checkpoint: str, size: str = "1 hour", late: str = "2 hours") -> StreamingQuery:
    """The windows that are over, each once, appended to Parquet files."""
    return window_metrics(requests, size, late).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_metrics(spark: SparkSession, out: str) -> DataFrame:
    """What the last batch of run_metrics wrote."""
    rows = spark.read.parquet(out)
    return rows.join(F.broadcast(rows.agg(F.max("batch_id").alias("batch_id"))), "batch_id").drop("batch_id")
