"""Derived price columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bucket names and their exclusive upper bounds; the rest is "high".
LOW, LOW_BELOW = "low", 80
MID, MID_BELOW = "mid", 120
HIGH = "high"


def range_bucket(close: Column) -> Column:
    """Price bucket of a close. NULL and NaN are below no bound, so they are "high"."""
    return F.when(close < LOW_BELOW, LOW).when(close < MID_BELOW, MID).otherwise(HIGH)


def hl_spread() -> Column:
    return F.col("high") - F.col("low")


def oc_change() -> Column:
    return F.col("close") - F.col("open")


def with_spread(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("hl_spread", hl_spread())


def silver_features(ticks: DataFrame) -> DataFrame:
    """Ticks plus the three silver columns; works on batch and streaming frames."""
    return ticks.withColumns(
        {
            "range_bucket": range_bucket(F.col("close")),
            "hl_spread": hl_spread(),
            "oc_change": oc_change(),
        }
    )
