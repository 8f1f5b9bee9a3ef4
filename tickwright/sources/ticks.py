"""Streams of ticks."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwright.functions.ticks import parse_ticks
from tickwright.schemas import ARRIVAL, TICK

# Fixed value: where a topic is read from on the first start.
STARTING = ("latest", "earliest")


def message_stream(
    spark: SparkSession,
    kind: str,
    location: str,
    starting: str = "latest",
    servers: str | None = None,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of raw messages with a ``value`` column.

    ``kafka``: ``location`` is the topic and ``servers`` the brokers; needs the connector
    package on the class path. ``json``: ``location`` is a folder of text files with one
    message per line, always read from the start. ``max_per_trigger`` bounds a batch, in
    offsets or in files.
    """
    if starting not in STARTING:
        raise ValueError(f"unknown starting point: {starting}")
    if kind == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", location)
            .option("startingOffsets", starting)
        )
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load()
    if kind == "json":
        reader = spark.readStream.format("text")
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return reader.load(location)
    raise ValueError(f"unknown message source: {kind}")


#: A topic's partition stands before the offset in a message's position.
_OFFSET_BITS = 48


def topic_position() -> Column:
    """One integer for a message's partition and offset, rising with the offset."""
    partition, offset = F.col("partition").cast("long"), F.col("offset")
    fits = (partition < 1 << (62 - _OFFSET_BITS)) & (offset < 1 << _OFFSET_BITS)
    message = F.concat(F.lit("no position for partition "), partition.cast("string"), F.lit(" offset "), offset.cast("string"))
    return F.when(fits, F.shiftleft(partition, _OFFSET_BITS) + offset).otherwise(F.raise_error(message).cast("long"))


def tick_stream(spark: SparkSession, kind: str, location: str, **options) -> DataFrame:
    """A stream of ticks from ``kafka``, ``json`` or ``parquet``.

    Ticks of a topic have their position in it as ``arrival``; those of files get one when a
    batch of them is stored.
    """
    if kind == "kafka":
        messages = message_stream(spark, kind, location, **options)
        return parse_ticks(messages.withColumn(ARRIVAL, topic_position()), keep=[ARRIVAL])
    if kind != "parquet":
        return parse_ticks(message_stream(spark, kind, location, **options))
    reader = spark.readStream.schema(TICK)
    if options.get("max_per_trigger"):
        reader = reader.option("maxFilesPerTrigger", options["max_per_trigger"])
    return reader.parquet(location)


def with_watermark(ticks: DataFrame, delay: str) -> DataFrame:
    """Set the watermark on the event time, which has to be an instant for that."""
    instant = F.col("event_time").try_cast("timestamp")
    return ticks.withColumn("event_time", instant).withWatermark("event_time", delay)
