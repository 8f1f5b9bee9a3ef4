"""The prediction column and its former name."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column names, the second one of tables from before the target was renamed.
PREDICTION = "pred_next_close"
LEGACY_PREDICTION = "pred_close"


def unify_prediction(df: DataFrame) -> DataFrame:
    """Offer ``pred_next_close`` on tables that only carry the legacy column."""
    if PREDICTION not in df.columns and LEGACY_PREDICTION in df.columns:
        return df.withColumn(PREDICTION, F.col(LEGACY_PREDICTION))
    return df
