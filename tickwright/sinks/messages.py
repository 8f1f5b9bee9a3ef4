"""Publishing ticks as messages."""

from pyspark.sql import DataFrame

from tickwright.functions.ticks import encode_ticks


def publish(ticks: DataFrame, kind: str, location: str, servers: str | None = None) -> None:
    """Publish a batch frame: to topic ``location``, or as text files below it."""
    messages = encode_ticks(ticks)
    if kind == "kafka":
        (
            messages.write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", location)
            .save()
        )
    elif kind == "json":
        messages.write.mode("append").text(location)
    else:
        raise ValueError(f"unknown message sink: {kind}")


def publish_stream(
    ticks: DataFrame, location: str, servers: str, checkpoint: str, name: str = "tick_publisher"
):
    """Publish a stream of ticks to the topic ``location``."""
    return (
        encode_ticks(ticks)
        .writeStream.format("kafka")
        .queryName(name)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", location)
        .option("checkpointLocation", checkpoint)
        .start()
    )
