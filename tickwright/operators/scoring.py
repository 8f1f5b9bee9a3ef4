"""Scoring of ticks with a stored model."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwright import settings
from tickwright.functions.numbers import absolute_error, is_finite, number_or_zero
from tickwright.functions.predictions import PREDICTION, unify_prediction
from tickwright.operators import ordering
from tickwright.operators.regression import LinearModel
from tickwright.schemas import FEATURES

# How a reader view names its origin.
DEMO_MODE = "demo_from_silver"
STREAM_MODE = "stream"


def add_missing_features(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Feature columns the frame lacks, as 0.0."""
    absent = [c for c in features if c not in df.columns]
    return df.withColumns({c: F.lit(0.0) for c in absent}) if absent else df


def fill_features(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """All feature columns as plain numbers: absent, NULL, NaN or no number gives 0.0."""
    present = add_missing_features(df, features)
    return present.withColumns({c: number_or_zero(F.col(c)) for c in features})


def score(df: DataFrame, model: LinearModel, out: str = PREDICTION) -> DataFrame:
    """Add the prediction; rows with a feature that is no finite number get NULL."""
    usable = reduce(lambda a, b: a & b, [is_finite(F.col(c)) for c in model.features])
    return df.withColumn(out, F.when(usable, model.expression()))


def score_ticks(ticks: DataFrame, model: LinearModel) -> DataFrame:
    """Filled features, prediction and the name of what is predicted; batch or stream."""
    scored = score(fill_features(ticks, model.features), model)
    return scored.withColumn("prediction_target", F.lit(model.target))


def with_errors(predictions: DataFrame, tie: str, **options) -> DataFrame:
    """Actual next close and absolute error, of the rows that have actual and prediction.

    An ``actual_next_close`` that is already there is kept.
    """
    df = unify_prediction(predictions)
    if "actual_next_close" not in df.columns:
        df = ordering.with_neighbour(df, "close", "actual_next_close", tie, **options)
    missed = absolute_error(F.col(PREDICTION), F.col("actual_next_close"))
    return df.withColumn("abs_error", missed).dropna(subset=["actual_next_close", PREDICTION])


def demo_predictions(
    silver: DataFrame,
    model: LinearModel,
    tie: str,
    n: int = settings.LATEST_PREDICTIONS,
) -> DataFrame:
    """Errors over the latest ``n`` silver rows, scored in place of stream predictions.

    Features are used as stored; a row that lacks one has no prediction and drops out.
    """
    silver = add_missing_features(silver, model.features)
    tail = ordering.latest(silver, n, ["event_time"], [tie])
    return with_errors(score(tail, model), tie).withColumn("source_mode", F.lit(DEMO_MODE))


def choose_view(predictions: DataFrame, demo: DataFrame) -> DataFrame:
    """Stream errors if there are any predictions, else the demo view."""
    if predictions.isEmpty():
        return demo
    return predictions.withColumn("source_mode", F.lit(STREAM_MODE))
