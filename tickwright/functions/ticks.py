"""Wire format: JSON messages to tick columns and back."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwright.schemas import TICK

# Fixed value: the wire form of an instant, ISO-8601 in UTC with microseconds.
WIRE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def parse_ticks(messages: DataFrame, value: str = "value", keep: list[str] = ()) -> DataFrame:
    """Messages to ticks. Every message yields a row.

    Text that is no JSON object (or NULL) yields a row of NULLs, a missing or wrongly
    typed field only a NULL field. ``keep`` carries message columns (such as a broker
    offset) through.
    """
    parsed = F.from_json(F.col(value).cast("string"), TICK)
    return messages.select(*keep, parsed.alias("tick")).select(*keep, "tick.*")


def tick_json(columns: list[str] | None = None) -> Column:
    """One tick as a JSON object, in schema order, NULL fields kept as null."""
    columns = columns or TICK.fieldNames()
    wire = [
        F.date_format(c, WIRE_TIME).alias(c) if c == "event_time" else F.col(c) for c in columns
    ]
    return F.to_json(F.struct(*wire), {"ignoreNullFields": "false"})


def encode_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks to unkeyed messages with a single ``value`` column."""
    return ticks.select(tick_json().alias("value"))
