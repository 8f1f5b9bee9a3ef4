"""Registered batch queries."""

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwright import settings
from tickwright.functions.numbers import human_bytes
from tickwright.functions.predictions import unify_prediction
from tickwright.functions.prices import silver_features, with_spread
from tickwright.functions.ticks import encode_ticks, parse_ticks, tick_json
from tickwright.operators import evaluation, regression, scoring, training
from tickwright.operators.windows import window_stats
from tickwright.plans.bridge import (
    TIE,
    daily,
    labelled,
    naive_times,
    plain_ticks,
    predictions,
    rounded,
    table,
    ticks,
)
from tickwright.schemas import FEATURES, HISTORY, MODEL, RUN_LOG, STATS, TARGET, TICK
from tickwright.session import prepare, scratch, written
from tickwright.sinks.tables import cached_history, write_snapshot
from tickwright.sources import batches, files, logs, payload, tables

Spark = SparkSession


# window statistics


def window_stats_tumbling(spark: Spark, sf_dir: str) -> DataFrame:
    return naive_times(rounded(window_stats(plain_ticks(spark, sf_dir), "10 seconds")))


def window_stats_hourly(spark: Spark, sf_dir: str) -> DataFrame:
    return naive_times(rounded(window_stats(plain_ticks(spark, sf_dir), "1 hour")))


def window_stats_sliding(spark: Spark, sf_dir: str) -> DataFrame:
    stats = window_stats(plain_ticks(spark, sf_dir), "1 hour", "30 minutes")
    return naive_times(rounded(stats))


# wire format and features


def tick_parse_json(spark: Spark, sf_dir: str) -> DataFrame:
    """All ticks as messages, some spoilt by volume: no JSON, fields lacking, wrong types."""
    volume = F.col("volume")
    text = (
        F.when(volume < 10, F.lit("not json"))
        .when(volume < 20, tick_json(["event_time", "symbol", "open"]))
        .when(volume < 30, F.regexp_replace(tick_json(), '"close":([^,]*),', '"close":"$1",'))
        .when(volume < 40, F.lit(None))
        .otherwise(tick_json())
    )
    messages = ticks(spark, sf_dir).select(TIE, text.cast("binary").alias("value"))
    return naive_times(parse_ticks(messages, keep=[TIE]))


def tick_encode_json(spark: Spark, sf_dir: str) -> DataFrame:
    """Fields taken back out of the encoded messages by path."""
    messages = encode_ticks(plain_ticks(spark, sf_dir))
    kinds = {"event_time": "string", "symbol": "string", "source": "string"}
    return messages.select(
        *[
            F.get_json_object("value", f"$.{c}").cast(kinds.get(c, "double")).alias(c)
            for c in TICK.fieldNames()
        ]
    )


def silver(spark: Spark, sf_dir: str) -> DataFrame:
    return naive_times(rounded(silver_features(ticks(spark, sf_dir))))


# training data


def next_close_label(spark: Spark, sf_dir: str) -> DataFrame:
    frame = training.label_next_close(ticks(spark, sf_dir), TIE)
    return naive_times(frame.select(TIE, "event_time", "symbol", "close", TARGET))


def next_close_label_sliced(spark: Spark, sf_dir: str) -> DataFrame:
    """The same label by way of slices, as a table beyond one slice takes it."""
    small = 2_500
    frame = training.label_next_close(
        ticks(spark, sf_dir, rows_per_slice=small), TIE, rows_per_slice=small
    )
    return naive_times(frame.select(TIE, "event_time", "symbol", "close", TARGET))


def training_set(spark: Spark, sf_dir: str) -> DataFrame:
    marked = training.label_next_close(with_spread(ticks(spark, sf_dir)), TIE)
    return rounded(training.training_rows(marked))


def history_clean(spark: Spark, sf_dir: str) -> DataFrame:
    """Daily history where days with a single order have no volume."""
    volume = F.when(F.col("volume") > 1, F.col("volume"))
    gaps = daily(spark, sf_dir).withColumn("volume", volume)
    return naive_times(rounded(training.clean_history(gaps), 4))


def training_topup(spark: Spark, sf_dir: str) -> DataFrame:
    """Silver one row short of the number asked for, so history joins it."""
    frame = silver_features(plain_ticks(spark, sf_dir))
    history = with_spread(daily(spark, sf_dir))
    wanted = table(spark, sf_dir, "events").count() + 1
    return naive_times(rounded(training.top_up(frame, history, min_rows=wanted), 4))


def history_cache(spark: Spark, sf_dir: str) -> DataFrame:
    """History built on the first call, read back on the second."""
    path = scratch(spark, "history")

    def build() -> DataFrame:
        return training.clean_history(daily(spark, sf_dir))

    cached_history(spark, path, build, min_rows=1)
    reused = cached_history(spark, path, build, min_rows=1)
    return naive_times(rounded(reused, 4))


def chrono_split(spark: Spark, sf_dir: str, **options) -> DataFrame:
    """Every labelled row with the part it belongs to."""
    rows = written(labelled(spark, sf_dir), "training")
    head, tail = training.chrono_split(rows, TIE, **options)
    return head.select(TIE, "symbol", F.lit("train").alias("part")).union(
        tail.select(TIE, "symbol", F.lit("test").alias("part"))
    )


def chrono_split_narrowed(spark: Spark, sf_dir: str) -> DataFrame:
    """The same parts, narrowed down sixteen counts at a time."""
    return chrono_split(spark, sf_dir, bins=16)


# regression


def linreg_single(spark: Spark, sf_dir: str) -> DataFrame:
    return rounded(regression.single_feature(labelled(spark, sf_dir)))


def linreg_train(spark: Spark, sf_dir: str) -> DataFrame:
    """Predictions for the rows held back, by a model that was stored and loaded again."""
    rows = written(labelled(spark, sf_dir), "training")
    head, tail = training.chrono_split(rows, TIE)
    path = scratch(spark, "model")
    regression.save(spark, regression.fit(head), {}, path)
    model, _ = regression.load(spark, path)
    scored = regression.predict(model, tail)
    return scored.select(TIE, "symbol", TARGET, F.round("prediction", 3).alias("prediction"))


def regression_metrics(spark: Spark, sf_dir: str) -> DataFrame:
    """The card of a trained and stored model."""
    rows = written(labelled(spark, sf_dir), "training")
    path = scratch(spark, "model")
    regression.save(spark, *regression.train(rows, TIE), path)
    card = spark.read.schema(MODEL).json(path)
    return rounded(card.select("mae", "rmse", "n_train", "n_test"), 4)


# scoring and evaluation


def score_fill_missing(spark: Spark, sf_dir: str) -> DataFrame:
    """Features as text, absent, NULL or no number, filled for scoring."""
    volume = F.col("volume")
    close = F.when(volume < 20, F.lit("x")).otherwise(F.col("close").cast("string"))
    high = F.when(volume < 40, F.lit(float("nan"))).when(volume >= 60, F.col("high"))
    spoilt = ticks(spark, sf_dir).select(
        TIE, "open", high.alias("high"), "low", close.alias("close")
    )
    return scoring.fill_features(spoilt).select(TIE, *FEATURES)


def legacy_prediction_alias(spark: Spark, sf_dir: str) -> DataFrame:
    old = predictions(spark, sf_dir).withColumnRenamed("pred_next_close", "pred_close")
    view = unify_prediction(old).select(TIE, "pred_close", "pred_next_close")
    return rounded(view, 4)


def latest_batches(spark: Spark, sf_dir: str) -> DataFrame:
    newest = evaluation.latest_batches(predictions(spark, sf_dir))
    return rounded(newest.select(TIE, "batch_id", "close", "pred_next_close"), 4)


def latest_batch_folders(spark: Spark, sf_dir: str) -> DataFrame:
    """The same rows from stored batches, of which only the newest folders are read."""
    path = scratch(spark, "predictions")
    # one job writes the folders of all batches, then each gets its entry in the log
    stored = predictions(spark, sf_dir).withColumn("own", F.col("batch_id"))
    stored.write.partitionBy("own").parquet(batches.folder(path, ""))
    for name, _ in files.children(spark, batches.folder(path, "")):
        if name.startswith("own="):
            files.mark(spark, batches.Entry(int(name[4:]), 0, name).marker(path))
    newest = tables.read_predictions(spark, path)
    return naive_times(
        rounded(newest.select("event_time", "symbol", "batch_id", "close", "pred_next_close"), 4)
    )


def _errors(spark: Spark, sf_dir: str) -> DataFrame:
    return scoring.with_errors(predictions(spark, sf_dir), TIE)


def online_error(spark: Spark, sf_dir: str) -> DataFrame:
    shown = _errors(spark, sf_dir).select(
        TIE, "symbol", "close", "pred_next_close", "actual_next_close", "abs_error"
    )
    return rounded(shown, 4)


def online_mae(spark: Spark, sf_dir: str) -> DataFrame:
    return rounded(evaluation.online_mae(_errors(spark, sf_dir)))


def pipeline_counts(spark: Spark, sf_dir: str) -> DataFrame:
    stats = window_stats(plain_ticks(spark, sf_dir))
    return evaluation.pipeline_counts(stats, _errors(spark, sf_dir))


def error_histogram(spark: Spark, sf_dir: str) -> DataFrame:
    return evaluation.error_histogram(_errors(spark, sf_dir))


def latest_windows(spark: Spark, sf_dir: str) -> DataFrame:
    stats = window_stats(plain_ticks(spark, sf_dir))
    view = evaluation.latest_windows(stats).select("window_end", "symbol", "var_close", "n_obs")
    return naive_times(rounded(view))


def latest_predictions(spark: Spark, sf_dir: str) -> DataFrame:
    newest = evaluation.latest_predictions(_errors(spark, sf_dir), TIE)
    view = newest.select(TIE, "event_time", "symbol", "actual_next_close", "pred_next_close")
    return naive_times(rounded(view, 4))


def series_avg_close(spark: Spark, sf_dir: str) -> DataFrame:
    stats = window_stats(plain_ticks(spark, sf_dir), "1 hour")
    return naive_times(rounded(evaluation.series_avg_close(stats)))


def pred_vs_actual_long(spark: Spark, sf_dir: str) -> DataFrame:
    view = evaluation.predicted_and_actual(_errors(spark, sf_dir), TIE)
    return naive_times(rounded(view, 4))


def demo_score_from_silver(spark: Spark, sf_dir: str) -> DataFrame:
    """No predictions are stored, so the latest silver rows are scored instead."""
    frame = silver_features(ticks(spark, sf_dir))
    model = regression.fit(labelled(spark, sf_dir))
    demo = scoring.demo_predictions(frame, model, TIE)
    stored = tables.read_predictions(spark, scratch(spark, "no-predictions"))
    view = scoring.choose_view(stored, demo).select(
        TIE, "symbol", "actual_next_close", "pred_next_close", "abs_error", "source_mode"
    )
    return rounded(view, 3)


# documents, tables and logs


def daily_payload_flatten(spark: Spark, sf_dir: str) -> DataFrame:
    documents = payload.build_daily(daily(spark, sf_dir))
    return naive_times(payload.flatten_daily(documents))


def tolerant_parquet_read(spark: Spark, sf_dir: str) -> DataFrame:
    """A table folder that also holds a zero-byte file and a file that is no Parquet."""
    path = scratch(spark, "ticks")
    with_spread(plain_ticks(spark, sf_dir)).write.parquet(path)
    files.write_text(spark, f"{path}/zero.parquet", "")
    files.write_text(spark, f"{path}/damaged.parquet", "no parquet")
    return naive_times(rounded(tables.read_tolerant(spark, path, HISTORY)))


def stats_snapshot(spark: Spark, sf_dir: str) -> DataFrame:
    """A snapshot written twice; readers see the second version whole."""
    path = scratch(spark, "stats")
    stats = window_stats(plain_ticks(spark, sf_dir), "1 hour")
    write_snapshot(stats.withColumn("n_obs", F.lit(0).cast("long")), path, ["window_start"])
    write_snapshot(stats, path, ["window_start", "symbol"])
    return naive_times(rounded(tables.read_stats(spark, path)))


def stats_read_latest(spark: Spark, sf_dir: str) -> DataFrame:
    """Without a snapshot, all part files of an older table are read, however many."""
    path = scratch(spark, "stats")
    window_stats(plain_ticks(spark, sf_dir), "1 hour").repartition(40).write.parquet(path)
    return naive_times(rounded(tables.read_stats(spark, path).select(*STATS.fieldNames())))


def stats_read_newest_files(spark: Spark, sf_dir: str) -> DataFrame:
    """The explicit thirty newest part files, by time: those of the table's last append."""
    path = scratch(spark, "stats")
    stats = window_stats(plain_ticks(spark, sf_dir), "1 hour")
    stats.withColumn("n_obs", F.lit(0).cast("long")).repartition(10).write.parquet(path)
    time.sleep(1)  # some stores keep whole seconds only
    parts = settings.LATEST_BATCHES
    stats.repartition(parts).write.mode("append").parquet(path)
    return naive_times(rounded(tables.read_stats(spark, path, n_files=parts)))


def run_log_latest(spark: Spark, sf_dir: str) -> DataFrame:
    """Events as a run log in CSV: the type is the command, the value the time it took."""
    path = scratch(spark, "run-log")
    table(spark, sf_dir, "events").select(
        F.date_format("ts", logs.RUN_TIME).alias("timestamp_utc"),
        F.col("event_type").alias("command"),
        (F.col("value") / 7).alias("elapsed_seconds"),
        F.get_json_object("props", "$.k").cast("int").alias("return_code"),
    ).select(*RUN_LOG.fieldNames()).write.option("header", True).csv(path)
    return evaluation.latest_runs(logs.read_run_log(spark, path))


def human_bytes_view(spark: Spark, sf_dir: str) -> DataFrame:
    """Values scaled over all units: the longer the type's name, the larger the unit."""
    scale = F.pow(F.lit(1024.0), F.length("event_type") - 4)
    size = F.floor(F.col("value") * scale)
    return table(spark, sf_dir, "events").select(TIE, human_bytes(size).alias("size"))


QUERIES = {
    "window_stats_tumbling": window_stats_tumbling,
    "window_stats_hourly": window_stats_hourly,
    "window_stats_sliding": window_stats_sliding,
    "tick_parse_json": tick_parse_json,
    "tick_encode_json": tick_encode_json,
    "silver_features": silver,
    "next_close_label": next_close_label,
    "next_close_label_sliced": next_close_label_sliced,
    "training_set": training_set,
    "history_clean": history_clean,
    "training_topup": training_topup,
    "history_cache": history_cache,
    "chrono_split": chrono_split,
    "chrono_split_narrowed": chrono_split_narrowed,
    "linreg_single": linreg_single,
    "linreg_train": linreg_train,
    "regression_metrics": regression_metrics,
    "score_fill_missing": score_fill_missing,
    "legacy_prediction_alias": legacy_prediction_alias,
    "latest_batches": latest_batches,
    "latest_batch_folders": latest_batch_folders,
    "online_error": online_error,
    "online_mae": online_mae,
    "pipeline_counts": pipeline_counts,
    "error_histogram": error_histogram,
    "latest_windows": latest_windows,
    "latest_predictions": latest_predictions,
    "series_avg_close": series_avg_close,
    "pred_vs_actual_long": pred_vs_actual_long,
    "demo_score_from_silver": demo_score_from_silver,
    "daily_payload_flatten": daily_payload_flatten,
    "tolerant_parquet_read": tolerant_parquet_read,
    "stats_snapshot": stats_snapshot,
    "stats_read_latest": stats_read_latest,
    "stats_read_newest_files": stats_read_newest_files,
    "run_log_latest": run_log_latest,
    "human_bytes": human_bytes_view,
}


def prepared(query):
    """The query with the session settings its result depends on."""

    def run(spark: Spark, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir)

    return run
