"""Reader views: online error, histogram, latest rows, chart series."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwright import settings
from tickwright.operators.ordering import latest
from tickwright.session import written


def online_mae(errors: DataFrame) -> DataFrame:
    """One row: mean absolute error over all rows, 0.0 when there are none."""
    return errors.agg(F.coalesce(F.avg("abs_error"), F.lit(0.0)).alias("mae"))


def pipeline_counts(stats: DataFrame, errors: DataFrame) -> DataFrame:
    """One row: window rows and evaluated predictions."""
    windows = stats.agg(F.count(F.lit(1)).alias("n")).scalar()
    predictions = errors.agg(F.count(F.lit(1)).alias("n")).scalar()
    return stats.sparkSession.range(1).select(
        windows.alias("n_windows"), predictions.alias("n_predictions")
    )


def error_histogram(
    errors: DataFrame, column: str = "abs_error", bins: int = settings.HISTOGRAM_BINS
) -> DataFrame:
    """Rows per bin of equal width between the smallest and the largest value.

    The largest value belongs to the last bin, empty bins have no row, and values that
    are all equal fall in bin 0. What gives the errors runs once: the values, a single column, are
    written, and their range and bins are read off that.
    """
    values = errors.select(F.col(column).alias("x")).where(F.col("x").isNotNull())
    values = written(values, "histogram")
    low, high = values.agg(F.min("x"), F.max("x")).first()
    if low is None or high == low:
        bin_no = F.lit(0)
    else:
        bin_no = F.floor((F.col("x") - low) / (high - low) * bins)
    return (
        values.select(F.least(bin_no, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def latest_windows(stats: DataFrame, n: int = settings.LATEST_WINDOWS) -> DataFrame:
    return latest(stats, n, ["window_start"], ["symbol"])


def latest_predictions(
    errors: DataFrame, tie: str, n: int = settings.LATEST_PREDICTIONS
) -> DataFrame:
    return latest(errors, n, ["event_time"], [tie])


def latest_runs(run_log: DataFrame, n: int = settings.LATEST_RUNS) -> DataFrame:
    """The last runs with their time in seconds to three decimals (halves to even)."""
    return latest(run_log, n, ["timestamp_utc"], ["command"]).select(
        "timestamp_utc",
        "command",
        F.bround("elapsed_seconds", 3).alias("elapsed_seconds"),
        "return_code",
    )


def latest_batches(predictions: DataFrame, n: int = settings.LATEST_BATCHES) -> DataFrame:
    """Rows of the ``n`` highest batch ids.

    The broadcast side is a list of at most ``n`` ids.
    """
    newest = predictions.select("batch_id").distinct().orderBy(F.desc("batch_id")).limit(n)
    return predictions.join(F.broadcast(newest), "batch_id", "left_semi")


def series_avg_close(stats: DataFrame) -> DataFrame:
    return stats.select("window_start", "symbol", "avg_close").orderBy("symbol", "window_start")


def predicted_and_actual(errors: DataFrame, tie: str, n: int = settings.LATEST_PREDICTIONS):
    """Latest predictions in long form: one row per (tick, series)."""
    return latest_predictions(errors, tie, n).unpivot(
        ["event_time", "symbol", tie],
        ["actual_next_close", "pred_next_close"],
        "series",
        "price",
    )
