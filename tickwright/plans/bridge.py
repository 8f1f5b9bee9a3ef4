"""Ticks, history and predictions derived from the benchmark tables.

``events`` become ticks: the type is the symbol, the value the close, the previous value
of the type the open. ``orders`` become daily history: the priority is the symbol.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwright.functions.prices import with_spread
from tickwright.operators.ordering import ROWS_PER_SLICE, with_neighbour
from tickwright.operators.regression import LinearModel, single_feature
from tickwright.operators.training import label_next_close, training_rows
from tickwright.schemas import TICK
from tickwright.sources.payload import DAILY_SOURCE

TIE = "event_id"
AVERAGES = ["avg_close", "var_close", "avg_volume"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def naive_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the tables have them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Computed doubles without the digits that depend on the order of summation.

    The average of 32 prices in cents may end exactly half way between two rounded
    values. Averages first become decimals, which are free of what summation added to the
    last digits of a double, so such halves are rounded alike however their sums came about.
    """

    def shown(name: str):
        if name not in AVERAGES:
            return F.round(name, digits).alias(name)
        return F.round(F.col(name).cast("decimal(30, 9)"), digits).cast("double").alias(name)

    return df.select(
        *[
            shown(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema
        ]
    )


def ticks(spark: SparkSession, sf_dir: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """One tick per event, with its ``event_id`` in front."""
    quotes = table(spark, sf_dir, "events").select(
        TIE,
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("close"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
    )
    opened = with_neighbour(
        quotes, "close", "before", TIE, step="previous", rows_per_slice=rows_per_slice
    ).withColumn("open", F.coalesce("before", "close"))
    return opened.select(
        TIE,
        "event_time",
        "symbol",
        "open",
        F.greatest("open", "close").alias("high"),
        F.least("open", "close").alias("low"),
        "close",
        "volume",
        F.lit("events").alias("source"),
    )


def plain_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks without the event id."""
    return ticks(spark, sf_dir).select(*TICK.fieldNames())


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows with the keys of their order."""
    marked = label_next_close(with_spread(ticks(spark, sf_dir)), TIE)
    return training_rows(marked, keep=[TIE, "event_time", "symbol"])


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily prices per order priority; the volume is the number of orders."""
    orders = table(spark, sf_dir, "orders")
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    return (
        orders.groupBy(
            F.col("o_orderdate").cast("timestamp").alias("event_time"),
            F.col("o_orderpriority").alias("symbol"),
        )
        .agg(
            F.min_by(price, key).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, key).alias("close"),
            F.count(F.lit(1)).cast("double").alias("volume"),
        )
        .withColumn("source", F.lit(DAILY_SOURCE))
        .select(*TICK.fieldNames())
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks scored with the least-squares line of the next close on the close.

    Each half day is a batch.
    """
    frame = with_spread(ticks(spark, sf_dir))
    line = single_feature(labelled(spark, sf_dir)).first()
    model = LinearModel(["close"], [line["slope"]], line["intercept"])
    half_days = F.floor(F.unix_seconds("event_time") / 43200).cast("int")
    return frame.select(
        "*",
        model.expression().alias("pred_next_close"),
        F.lit(model.target).alias("prediction_target"),
        half_days.alias("batch_id"),
    )
