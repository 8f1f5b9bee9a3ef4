"""Event-time window statistics, the same on batch and streaming frames.

Sliding windows overlap, so a tick counts in size / slide of them. Batches are first reduced to
panes, the stretches of time that every window holds whole or not at all; only panes are copied to the
windows they belong to. A pane keeps what merges exactly: counts, extremes, the mean and the sum of
squared deviations from it.
"""

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The names of the statistics, in the order of the table.
STATISTICS = ["min_close", "max_close", "avg_close", "var_close", "avg_volume", "n_obs"]


def window_stats(ticks: DataFrame, size: str = "10 seconds", slide: str | None = None) -> DataFrame:
    """Close and volume statistics per (window, symbol).

    Windows are aligned to the epoch; with a slide below the size a tick counts in
    several. Ticks without an event time are in no window, ticks without a symbol form
    a group of their own. The sample variance of a single close is NULL. All statistics
    merge, so a hot (window, symbol) is reduced before the shuffle. Streams keep a state per window,
    as which windows a late tick still counts in is decided window by window.
    """
    if not ticks.isStreaming and overlapping(ticks.sparkSession, size, slide):
        return widen(panes(ticks, size, slide), size, slide)
    span = F.window("event_time", size, slide or size)
    return (
        ticks.groupBy(span.alias("span"), "symbol")
        .agg(
            F.min("close").alias("min_close"),
            F.max("close").alias("max_close"),
            F.avg("close").alias("avg_close"),
            F.var_samp("close").alias("var_close"),
            F.avg("volume").alias("avg_volume"),
            F.count(F.lit(1)).alias("n_obs"),
        )
        .select(
            F.col("span.start").alias("window_start"),
            F.col("span.end").alias("window_end"),
            "symbol",
            *STATISTICS,
        )
    )


_known_spans: dict[str, int] = {}


def _micros(spark: SparkSession, span: str) -> int:
    """A span in microseconds, as Spark reads it; asked for once."""
    if span not in _known_spans:
        epoch = "TIMESTAMP '1970-01-01 00:00:00 UTC'"
        read = spark.sql(f"SELECT unix_micros({epoch} + INTERVAL '{span}')")
        _known_spans[span] = read.first()[0]
    return _known_spans[span]


def overlapping(spark: SparkSession, size: str, slide: str | None) -> bool:
    return slide is not None and _micros(spark, slide) < _micros(spark, size)


def panes(ticks: DataFrame, size: str, slide: str) -> DataFrame:
    """Partial statistics per (pane, symbol); panes are as long as the largest common part of size and slide."""
    spark = ticks.sparkSession
    width = math.gcd(_micros(spark, size), _micros(spark, slide))
    n = F.count("close")
    return (
        ticks.groupBy(F.window("event_time", f"{width} microseconds").alias("span"), "symbol")
        .agg(
            F.min("close").alias("min_close"),
            F.max("close").alias("max_close"),
            n.alias("n_close"),
            F.avg("close").alias("mean"),
            (F.var_pop("close") * n).alias("squares"),
            F.sum("volume").alias("volume"),
            F.count("volume").alias("n_volume"),
            F.count(F.lit(1)).alias("n_obs"),
        )
        .select(F.col("span.start").alias("pane"), "symbol", "min_close", "max_close", "n_close", "mean", "squares",
                "volume", "n_volume", "n_obs")
    )


def _merged(one: Column, other: Column) -> Column:
    """Number, mean and squared deviations of two disjoint sets together."""
    n = one["n"] + other["n"]
    apart = other["mean"] - one["mean"]
    return F.struct(
        n.alias("n"),
        (one["mean"] + apart * other["n"] / n).alias("mean"),
        (one["squares"] + other["squares"] + apart * apart * one["n"] * other["n"] / n).alias("squares"),
    )


def widen(parts: DataFrame, size: str, slide: str) -> DataFrame:
    """The statistics of ``window_stats`` from panes of the same size and slide.

    A window of a symbol is put together from at most as many panes as fit it.
    """
    spark = parts.sparkSession
    long, step = _micros(spark, size), _micros(spark, slide)
    width = math.gcd(long, step)
    kind = parts.schema["pane"].dataType
    at = F.unix_micros(F.col("pane").cast("timestamp"))
    # the windows that begin at or before the pane and end at or after it
    last = at - F.pmod(at, F.lit(step))
    first = at + width - long
    first = first + F.pmod(-first, F.lit(step))
    # with gaps between windows a pane may be in none
    starts = F.when(first <= last, F.sequence(first, last, F.lit(step)))
    copies = parts.select("*", F.explode(starts).alias("start"))
    moments = F.struct(F.col("n_close").alias("n"), "mean", "squares")
    found = F.when(F.col("n_close") > 0, F.struct("pane", moments.alias("own")))
    merged = copies.groupBy("start", "symbol").agg(
        F.min("min_close").alias("min_close"),
        F.max("max_close").alias("max_close"),
        F.array_sort(F.collect_list(found)).alias("parts"),
        (F.sum("volume") / F.nullif(F.sum("n_volume"), F.lit(0))).alias("avg_volume"),
        F.sum("n_obs").alias("n_obs"),
    )
    own = F.transform("parts", lambda x: x["own"])
    whole = F.aggregate(F.slice(own, 2, F.size(own)), F.get(own, F.lit(0)), _merged)
    merged = merged.withColumn("whole", F.when(F.size("parts") > 0, whole))
    n = F.col("whole.n")
    return merged.select(
        F.timestamp_micros("start").cast(kind).alias("window_start"),
        F.timestamp_micros(F.col("start") + long).cast(kind).alias("window_end"),
        "symbol",
        "min_close",
        "max_close",
        F.col("whole.mean").alias("avg_close"),
        F.when(n > 1, F.col("whole.squares") / (n - 1)).alias("var_close"),
        "avg_volume",
        "n_obs",
    )
