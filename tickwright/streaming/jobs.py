"""The streams: raw and feature tables, window statistics, predictions."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickwright.functions.prices import silver_features, with_spread
from tickwright.operators.regression import LinearModel
from tickwright.operators.scoring import score_ticks
from tickwright.operators.windows import overlapping, panes, widen, window_stats
from tickwright.settings import WATERMARK
from tickwright.operators.rows import numbered
from tickwright.schemas import ARRIVAL
from tickwright.sinks.batches import FAN, fold, write_batch
from tickwright.sinks.tables import write_snapshot
from tickwright.sources.tables import latest_changes
from tickwright.sources.ticks import with_watermark
from tickwright.streaming.lifecycle import state_settings

STATS_ORDER = ["window_start", "symbol"]

# What the streams are called in progress documents.
BRONZE, SILVER = "bronze_sink", "silver_sink"
STATS_SNAPSHOT, STATS_CONSOLE = "stats_snapshot", "stats_console"
PREDICTIONS = "predictions"

Trigger = dict | None

# Works off what is there and ends. Without a trigger, batches follow each other at once.
AVAILABLE_NOW = {"availableNow": True}


def _start(writer: DataStreamWriter, checkpoint: str | None, trigger: Trigger) -> StreamingQuery:
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def _append_table(df, path, name, checkpoint, trigger):
    writer = df.writeStream.format("parquet").queryName(name).outputMode("append")
    return _start(writer.option("path", path), checkpoint, trigger)


def start_bronze(ticks: DataFrame, path: str, checkpoint: str, trigger: Trigger = None):
    """Append the ticks as they are, rows of NULLs from broken messages included."""
    watermarked = with_watermark(ticks, WATERMARK)
    return _append_table(watermarked, path, BRONZE, checkpoint, trigger)


def start_silver(ticks: DataFrame, path: str, checkpoint: str, trigger: Trigger = None):
    """Append the ticks with their feature columns."""
    features = silver_features(with_watermark(ticks, WATERMARK))
    return _append_table(features, path, SILVER, checkpoint, trigger)


def start_bronze_and_silver(
    ticks: DataFrame,
    bronze: str,
    silver: str,
    checkpoint: str,
    trigger: Trigger = None,
    folded: int = FAN,
):
    """Both tables from one stream: messages are read and parsed once instead of twice.

    Each micro-batch has a folder of its own in either table, so a repeated batch
    replaces what an earlier try left; older ones are folded into larger files. Ticks keep
    their place of arrival in both.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            # ticks of a topic have their place
            placed = batch if ARRIVAL in batch.columns else numbered(batch, ARRIVAL, batch_id)
            write_batch(placed, bronze, batch_id)
            write_batch(silver_features(placed), silver, batch_id)
        finally:
            batch.unpersist()
        for table in (bronze, silver):
            fold(batch.sparkSession, table, fan=folded)

    writer = ticks.writeStream.queryName("bronze_silver").outputMode("append")
    return _start(writer.foreachBatch(store), checkpoint, trigger)


def streaming_stats(ticks: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    return window_stats(with_watermark(ticks, WATERMARK), size, slide)


def start_stats_snapshot(
    ticks: DataFrame,
    path: str,
    checkpoint: str,
    size: str = "10 seconds",
    slide: str | None = None,
    trigger: Trigger = None,
    **state,
):
    """Keep a snapshot table of all windows ever seen.

    Complete mode: late ticks still count, and the state keeps every window, or with a slide
    every pane, from which each batch puts the overlapping windows together. For streams
    without end prefer ``start_stats_changes``.
    """
    sliding = overlapping(ticks.sparkSession, size, slide)

    def store(batch: DataFrame, batch_id: int) -> None:
        write_snapshot(widen(batch, size, slide) if sliding else batch, path, STATS_ORDER)

    watermarked = with_watermark(ticks, WATERMARK)
    kept = panes(watermarked, size, slide) if sliding else window_stats(watermarked, size, slide)
    writer = (
        kept.writeStream.queryName(STATS_SNAPSHOT)
        .outputMode("complete")
        .foreachBatch(store)
    )
    with state_settings(ticks.sparkSession, **state):
        return _start(writer, checkpoint, trigger)


def start_stats_changes(
    ticks: DataFrame,
    path: str,
    checkpoint: str,
    size: str = "10 seconds",
    slide: str | None = None,
    trigger: Trigger = None,
    folded: int = FAN,
    **state,
):
    """Append the windows each batch changed; ``read_stats_changes`` gives their last state.

    Update mode: a window leaves the state once the watermark has passed it, and each
    batch writes only what it changed, so neither grows with the age of the stream. Every
    ``folded`` batches are folded into a segment with a row per window, as many segments into
    one of the next level, so readers open few folders however old the stream is.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)
        fold(batch.sparkSession, path, latest_changes, fan=folded)

    writer = (
        streaming_stats(ticks, size, slide)
        .writeStream.queryName("stats_changes")
        .outputMode("update")
        .foreachBatch(store)
    )
    with state_settings(ticks.sparkSession, **state):
        return _start(writer, checkpoint, trigger)


def start_stats_final(
    ticks: DataFrame,
    path: str,
    checkpoint: str,
    size: str = "10 seconds",
    slide: str | None = None,
    trigger: Trigger = None,
    **state,
):
    """Append every window once, after the watermark has passed its end."""
    final = streaming_stats(ticks, size, slide)
    with state_settings(ticks.sparkSession, **state):
        return _append_table(final, path, "stats_final", checkpoint, trigger)


def start_stats_console(
    ticks: DataFrame,
    size: str = "10 seconds",
    slide: str | None = None,
    rows: int = 10,
    trigger: Trigger = None,
    **state,
):
    """Print the windows each batch changed; keeps no checkpoint."""
    writer = (
        streaming_stats(ticks, size, slide)
        .writeStream.queryName(STATS_CONSOLE)
        .outputMode("update")
        .format("console")
        .option("truncate", False)
        .option("numRows", rows)
    )
    with state_settings(ticks.sparkSession, **state):
        return _start(writer, None, trigger)


def start_scoring(
    ticks: DataFrame,
    model: LinearModel,
    path: str,
    checkpoint: str,
    trigger: Trigger = None,
    folded: int = FAN,
):
    """Score the ticks and store one folder of predictions per micro-batch; older ones are folded."""

    def store(batch: DataFrame, batch_id: int) -> None:
        if ARRIVAL in batch.columns:
            write_batch(batch, path, batch_id)
        else:
            # read twice: to be numbered, then to be written
            batch = batch.persist()
            try:
                write_batch(numbered(batch, ARRIVAL, batch_id), path, batch_id)
            finally:
                batch.unpersist()
        fold(batch.sparkSession, path, fan=folded)

    scored = score_ticks(with_spread(ticks), model)
    writer = (
        scored.writeStream.queryName(PREDICTIONS).outputMode("append").foreachBatch(store)
    )
    return _start(writer, checkpoint, trigger)
