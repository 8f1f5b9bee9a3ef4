"""Daily price series documents: one JSON object per symbol, one entry per day."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwright.functions.numbers import plain_number
from tickwright.schemas import PAYLOAD, PAYLOAD_FIELDS, PAYLOAD_META, PAYLOAD_SERIES, PAYLOAD_SYMBOL

# Fixed value: the source tag of rows from daily payloads.
DAILY_SOURCE = "alphavantage_daily"


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Saved documents, one per file, as a ``payload`` text column."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")


def flatten_daily(documents: DataFrame, symbol: Column | None = None) -> DataFrame:
    """Documents to ticks, one per day.

    Values are text in the document; what is no number becomes NULL. Documents without a
    series yield nothing. ``symbol`` stands in where a document's header names none.
    """
    parsed = documents.withColumn("doc", F.from_json("payload", PAYLOAD))
    named = F.col("doc").getField(PAYLOAD_META).getField(PAYLOAD_SYMBOL)
    days = parsed.select(
        (named if symbol is None else F.coalesce(named, symbol)).alias("symbol"),
        F.explode(F.col("doc").getField(PAYLOAD_SERIES)).alias("day", "quote"),
    )
    prices = {
        name: plain_number(F.col("quote").getField(key))
        for name, key in PAYLOAD_FIELDS.items()
    }
    return days.select(
        F.try_to_timestamp("day", F.lit("yyyy-MM-dd")).alias("event_time"),
        "symbol",
        *[value.alias(name) for name, value in prices.items()],
        F.lit(DAILY_SOURCE).alias("source"),
    )


def build_daily(daily: DataFrame) -> DataFrame:
    """Daily ticks to documents, one per symbol and year (at most 366 entries each)."""
    quote = F.struct(
        *[F.col(name).cast("string").alias(key) for name, key in PAYLOAD_FIELDS.items()]
    )
    entry = F.struct(F.date_format("event_time", "yyyy-MM-dd").alias("day"), quote.alias("quote"))
    series = F.map_from_entries(F.collect_list(entry))
    header = F.struct(F.col("symbol").alias(PAYLOAD_SYMBOL))
    return (
        daily.groupBy("symbol", F.year("event_time").alias("year"))
        .agg(series.alias("series"))
        .select(
            F.to_json(
                F.struct(header.alias(PAYLOAD_META), F.col("series").alias(PAYLOAD_SERIES))
            ).alias("payload")
        )
    )
