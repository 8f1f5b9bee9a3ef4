"""Registered streaming queries: each works off the ticks as a stream and reads the output."""

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwright.functions.ticks import parse_ticks
from tickwright.operators import regression
from tickwright.plans.bridge import labelled, naive_times, plain_ticks, rounded
from tickwright.schemas import STATS, TICK
from tickwright.session import scratch, written
from tickwright.sinks.messages import publish
from tickwright.sources import logs, tables
from tickwright.sources.ticks import message_stream, tick_stream
from tickwright.streaming import jobs, progress

Spark = SparkSession


#: Micro-batches a query's messages are published for, and files of each.
SLICES, FILES = 12, 2


def published(spark: Spark, sf_dir: str, slices: int = 1) -> str:
    """Folder with all ticks as JSON messages, written slice of time by slice of time.

    A stream that takes ``FILES`` files at a time sees one slice in each micro-batch.
    """
    path = scratch(spark, "messages")
    ticks = plain_ticks(spark, sf_dir)
    if slices == 1:
        publish(ticks, "json", path)
        return path
    ticks = written(ticks, "ticks")
    instant = F.unix_micros("event_time")
    shares = [i / slices for i in range(1, slices)]
    cuts = ticks.select(instant.cast("double").alias("at")).approxQuantile("at", shares, 0.01)
    for low, high in zip([None, *cuts], [*cuts, None]):
        own = F.lit(True) if low is None else instant >= low
        own = own if high is None else own & (instant < high)
        publish(ticks.where(own).repartition(FILES), "json", path)
        time.sleep(0.01)  # files are taken in the order of their times
    return path


def finish(query) -> None:
    """Wait for a stream that works off what is there; its error becomes ours."""
    query.awaitTermination()


def _run(start, spark: Spark, sf_dir: str, **options) -> str:
    """Run one of the jobs over all messages and return the path of its output."""
    ticks = tick_stream(spark, "json", published(spark, sf_dir, SLICES), max_per_trigger=FILES)
    out, checkpoint = scratch(spark, "output"), scratch(spark, "checkpoint")
    finish(start(ticks, out, checkpoint, trigger=jobs.AVAILABLE_NOW, **options))
    return out


def stream_source_json(spark: Spark, sf_dir: str) -> DataFrame:
    """Messages stored unparsed by a stream, then parsed by the same function in a batch."""
    messages = message_stream(spark, "json", published(spark, sf_dir))
    out = scratch(spark, "raw")
    writer = messages.writeStream.format("parquet").trigger(**jobs.AVAILABLE_NOW)
    finish(writer.option("checkpointLocation", scratch(spark, "checkpoint")).start(out))
    return naive_times(parse_ticks(spark.read.schema("value string").parquet(out)))


def stream_bronze_append(spark: Spark, sf_dir: str) -> DataFrame:
    path = _run(jobs.start_bronze, spark, sf_dir)
    return naive_times(tables.read_tolerant(spark, path, TICK))


def stream_silver_append(spark: Spark, sf_dir: str) -> DataFrame:
    path = _run(jobs.start_silver, spark, sf_dir)
    return naive_times(rounded(tables.read_silver(spark, path)))


def stream_window_stats_complete(spark: Spark, sf_dir: str) -> DataFrame:
    path = _run(jobs.start_stats_snapshot, spark, sf_dir, size="1 hour")
    return naive_times(rounded(tables.read_stats(spark, path)))


def stream_window_stats_update(spark: Spark, sf_dir: str) -> DataFrame:
    path = _run(jobs.start_stats_changes, spark, sf_dir, size="1 hour")
    return naive_times(rounded(tables.read_stats_changes(spark, path)))


def stream_window_stats_append(spark: Spark, sf_dir: str) -> DataFrame:
    path = _run(jobs.start_stats_final, spark, sf_dir, size="1 hour")
    return naive_times(rounded(tables.read_tolerant(spark, path, STATS)))


def stream_window_stats_sliding(spark: Spark, sf_dir: str) -> DataFrame:
    path = _run(jobs.start_stats_changes, spark, sf_dir, size="1 hour", slide="30 minutes")
    return naive_times(rounded(tables.read_stats_changes(spark, path)))


def stream_score(spark: Spark, sf_dir: str) -> DataFrame:
    """Predictions of a model trained on the same ticks."""
    model = regression.fit(labelled(spark, sf_dir))
    ticks = tick_stream(spark, "json", published(spark, sf_dir, SLICES), max_per_trigger=FILES)
    out, checkpoint = scratch(spark, "predictions"), scratch(spark, "checkpoint")
    finish(jobs.start_scoring(ticks, model, out, checkpoint, trigger=jobs.AVAILABLE_NOW))
    stored = tables.read_predictions(spark, out, n_batches=None)
    view = stored.select("event_time", "symbol", "close", "pred_next_close", "prediction_target")
    return naive_times(rounded(view, 3))


def stream_progress_metrics(spark: Spark, sf_dir: str) -> DataFrame:
    """Rows read, windows held and late rows of a finished stream, from its progress files."""
    path = scratch(spark, "progress")
    listener = progress.watch(spark, path)
    try:
        _run(jobs.start_stats_snapshot, spark, sf_dir, size="1 hour")
        progress.drain(spark)
    finally:
        spark.streams.removeListener(listener)
    return (
        logs.progress_metrics(logs.read_progress(spark, path))
        .where(F.col("name") == "stats_snapshot")
        .groupBy("name")
        .agg(
            F.sum("input_rows").alias("input_rows"),
            F.max("state_rows").alias("state_rows"),
            F.sum("dropped_rows").alias("dropped_rows"),
        )
    )


QUERIES = {
    "stream_source_json": stream_source_json,
    "stream_bronze_append": stream_bronze_append,
    "stream_silver_append": stream_silver_append,
    "stream_window_stats_complete": stream_window_stats_complete,
    "stream_window_stats_update": stream_window_stats_update,
    "stream_window_stats_append": stream_window_stats_append,
    "stream_window_stats_sliding": stream_window_stats_sliding,
    "stream_score": stream_score,
    "stream_progress_metrics": stream_progress_metrics,
}
