"""The jobs a user starts: stream, train, predict, report, clean."""

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwright.operators import evaluation, regression, scoring, training
from tickwright.schemas import HISTORY, SILVER
from tickwright.session import build_session, clear_scratch, stored, written
from tickwright.settings import Settings
from tickwright.sinks.batches import GRACE, vacuum
from tickwright.sinks.tables import cached_history, clear_snapshot
from tickwright.sources import batches, files, logs, payload, tables
from tickwright.sources.ticks import tick_stream
from tickwright.streaming import jobs, lifecycle, progress

ROW_ID = "row_id"
BATCH_TABLES = ("bronze", "silver", "stats_changes", "predictions")
NO_MODEL = regression.LinearModel(["close"], [0.0], 0.0)


def ticks_from(spark: SparkSession, config: Settings, folder: str | None, starting: str):
    """The topic of the settings, or the messages in ``folder`` if one is named."""
    bound = config.max_per_trigger or None
    if folder:
        return tick_stream(spark, "json", folder, max_per_trigger=bound)
    return tick_stream(
        spark,
        "kafka",
        config.kafka_topic,
        servers=config.kafka_servers,
        starting=starting,
        max_per_trigger=bound,
    )


def start_processor(
    spark: SparkSession,
    config: Settings,
    folder: str | None = None,
    trigger=None,
    complete: bool = False,
) -> list:
    """Start the raw and feature tables, which share one stream, and the window statistics.

    ``complete`` keeps a snapshot of all windows ever seen instead of what changed, and prints
    the windows of each batch; its state and its batches grow with the age of the stream.
    """
    progress.watch(spark, config.table("logs/stream_progress"))
    ticks = ticks_from(spark, config, folder, "latest")
    span = {"size": config.window, "slide": config.slide, "trigger": trigger}
    tables_stream = jobs.start_bronze_and_silver(
        ticks,
        config.table("bronze"),
        config.table("silver"),
        config.checkpoint("processor/bronze_silver"),
        trigger,
    )
    if not complete:
        run = config.checkpoint("processor/stats_changes")
        changes = jobs.start_stats_changes(ticks, config.table("stats_changes"), run, **span)
        return [tables_stream, changes]
    clear_snapshot(spark, config.table("stats"))
    run = lifecycle.checkpoint_path(spark, config.checkpoint("processor/stats_snapshot"), "fresh")
    return [
        tables_stream,
        jobs.start_stats_snapshot(ticks, config.table("stats"), run, **span),
        jobs.start_stats_console(ticks, **span),
    ]


def read_statistics(spark: SparkSession, config: Settings) -> DataFrame:
    """The snapshot if one is kept, else the last state of every window that changed."""
    if tables.snapshot_versions(spark, config.table("stats")):
        return tables.read_stats(spark, config.table("stats"))
    return tables.read_stats_changes(spark, config.table("stats_changes"))


def load_history(spark: SparkSession, config: Settings, payloads: str | None) -> DataFrame:
    """Daily history, from the cached table or else from saved payload documents."""
    path = config.table("bootstrap")

    def build() -> DataFrame:
        documents = payload.read_payloads(spark, payloads)
        return training.clean_history(payload.flatten_daily(documents, F.lit(config.symbol)))

    if payloads:
        cached_history(spark, path, build)
    return tables.read_tolerant(spark, path, HISTORY, ROW_ID)


def train_model(spark: SparkSession, config: Settings, payloads: str | None = None) -> dict:
    """Fit on silver, topped up with history where silver is short; store the model."""
    silver = tables.read_tolerant(spark, config.table("silver"), SILVER, ROW_ID)
    ticks = training.top_up(silver, load_history(spark, config, payloads))
    labelled = training.label_next_close(ticks, ROW_ID)
    rows = training.training_rows(labelled, keep=[ROW_ID, "event_time", "symbol"])
    with stored(rows, "training") as table:
        model, measured = regression.train(table, ROW_ID)
    regression.save(spark, model, measured, config.table("models/linear_regression"))
    return measured


def start_predictor(
    spark: SparkSession, config: Settings, folder: str | None = None, trigger=None
):
    """Score the stream from its start with the stored model."""
    model, _ = regression.load(spark, config.table("models/linear_regression"))
    out = config.table("predictions")
    run = lifecycle.checkpoint_path(
        spark, config.checkpoint("predictor"), "replay_if_empty", output=out
    )
    ticks = ticks_from(spark, config, folder, "earliest")
    return jobs.start_scoring(ticks, model, out, run, trigger=trigger)


def report(spark: SparkSession, config: Settings) -> dict[str, DataFrame]:
    """The reader views over the stored tables, by name."""
    stats = read_statistics(spark, config)
    predictions = tables.read_predictions(spark, config.table("predictions"), row_id=ROW_ID)
    if predictions.isEmpty():
        errors = _demo(spark, config)
    else:
        errors = scoring.with_errors(predictions, ROW_ID)
    errors = written(errors, "errors")  # five views read it
    progressed = logs.read_progress(spark, config.table("logs/stream_progress"))
    runs = logs.read_run_log(spark, config.table("logs/benchmark_runs.csv"))
    return {
        "counts": evaluation.pipeline_counts(stats, errors),
        "online_mae": evaluation.online_mae(errors),
        "avg_close": evaluation.series_avg_close(stats),
        "latest_windows": evaluation.latest_windows(stats),
        "predicted_and_actual": evaluation.predicted_and_actual(errors, ROW_ID),
        "error_histogram": evaluation.error_histogram(
            evaluation.latest_predictions(errors, ROW_ID)
        ),
        "progress": logs.progress_metrics(logs.latest_progress(progressed)),
        "latest_runs": evaluation.latest_runs(runs),
    }


def _demo(spark: SparkSession, config: Settings) -> DataFrame:
    """Errors over the latest silver rows; none as long as there is no model."""
    path = config.table("models/linear_regression")
    silver = tables.read_tolerant(spark, config.table("silver"), SILVER, ROW_ID)
    if not files.exists(spark, path):
        return scoring.demo_predictions(silver.limit(0), NO_MODEL, ROW_ID)
    model, _ = regression.load(spark, path)
    return scoring.demo_predictions(silver, model, ROW_ID)


def clean(spark: SparkSession, config: Settings, grace: float = GRACE) -> dict[str, list[str]]:
    """Roll up progress documents, and remove what has not counted for ``grace`` seconds.

    Streams and readers may go on meanwhile; streams fold their tables by themselves. Returns the folders that went, by table.
    """
    gone = {}
    for name in BATCH_TABLES:
        if batches.logged(spark, config.table(name)):
            gone[name] = vacuum(spark, config.table(name), grace)
    progressed = config.table("logs/stream_progress")
    if files.exists(spark, progressed):
        progress.roll_up(spark, progressed)
        gone["progress"] = vacuum(spark, f"{progressed}/{logs.ROLLED}", grace)
    return gone


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tickwright")
    parser.add_argument("job", choices=["stream", "train", "predict", "report", "clean"])
    parser.add_argument("--messages", help="folder of JSON messages instead of the topic")
    parser.add_argument(
        "--complete", action="store_true", help="keep all windows as a snapshot and print them"
    )
    parser.add_argument("--payloads", help="folder of daily payload documents for training")
    args = parser.parse_args(arguments)
    config = Settings.from_env()
    spark = build_session(f"tickwright-{args.job}")
    try:
        _run(spark, config, args)
    finally:
        clear_scratch(spark)


def _run(spark: SparkSession, config: Settings, args: argparse.Namespace) -> None:
    if args.job == "stream":
        streams = start_processor(spark, config, args.messages, complete=args.complete)
        lifecycle.await_all(spark, streams)
    elif args.job == "predict":
        start_predictor(spark, config, args.messages).awaitTermination()
    elif args.job == "train":
        print(train_model(spark, config, args.payloads))
    elif args.job == "clean":
        print(clean(spark, config))
    else:
        for name, view in report(spark, config).items():
            print(name)
            view.show(truncate=False)


if __name__ == "__main__":
    main()
