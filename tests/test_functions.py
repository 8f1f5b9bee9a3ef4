import json
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwright.functions.numbers import human_bytes, number_or_zero
from tickwright.functions.prices import range_bucket, silver_features
from tickwright.functions.ticks import encode_ticks, parse_ticks
from tickwright.schemas import SILVER, TICK

GOOD = {
    "event_time": "2024-01-01T00:00:01.123456+00:00",
    "symbol": "IBM",
    "open": 1.0,
    "high": 2.5,
    "low": 0.5,
    "close": 2.0,
    "volume": 100.0,
    "source": "simulated",
}


def parse(spark, *messages):
    frame = spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "i int, value string")
    binary = frame.withColumn("value", F.col("value").cast("binary"))
    return [r.asDict() for r in parse_ticks(binary, keep=["i"]).orderBy("i").drop("i").collect()]


def test_good_message_gives_all_fields(spark):
    (row,) = parse(spark, json.dumps(GOOD))
    assert row["event_time"].isoformat() == "2024-01-01T00:00:01.123456"
    assert {k: v for k, v in row.items() if k != "event_time"} == {
        k: v for k, v in GOOD.items() if k != "event_time"
    }


def test_broken_messages_are_kept_as_rows_of_nulls(spark):
    rows = parse(spark, "not json", None, "[1]", "")
    assert len(rows) == 4
    assert all(value is None for row in rows for value in row.values())


def test_missing_and_mistyped_fields_only_lose_themselves(spark):
    missing = {k: GOOD[k] for k in ("event_time", "symbol", "open")}
    wrong = {**GOOD, "close": "7.5", "open": "abc", "event_time": "bad"}
    first, second = parse(spark, json.dumps(missing), json.dumps(wrong))
    assert first["open"] == 1.0 and first["close"] is None and first["source"] is None
    assert second["close"] is None and second["open"] is None and second["event_time"] is None
    assert second["high"] == 2.5 and second["symbol"] == "IBM"


def test_encoding_has_wire_keys_and_round_trips(spark):
    messages = spark.createDataFrame([(json.dumps(GOOD),)], "value string")
    ticks = parse_ticks(messages)
    encoded = encode_ticks(ticks)
    assert encoded.columns == ["value"]
    assert json.loads(encoded.first()["value"]) == GOOD
    assert parse_ticks(encoded).collect() == ticks.collect()


def test_encoding_keeps_null_fields(spark):
    empty = spark.createDataFrame([(None,) * len(TICK)], TICK)
    assert json.loads(encode_ticks(empty).first()["value"]) == dict.fromkeys(GOOD)


@pytest.mark.parametrize(
    ("close", "bucket"),
    [
        (79.99, "low"),
        (80.0, "mid"),
        (119.99, "mid"),
        (120.0, "high"),
        (None, "high"),
        (math.nan, "high"),
        (-math.inf, "low"),
    ],
)
def test_range_bucket_edges(spark, close, bucket):
    frame = spark.createDataFrame([(close,)], "close double")
    assert frame.select(range_bucket(F.col("close"))).first()[0] == bucket


def test_silver_columns_propagate_null(spark):
    row = (None, "A", 1.0, None, 0.5, 2.0, 1.0, "s")
    silver = silver_features(spark.createDataFrame([row], TICK))
    assert silver.columns == SILVER.fieldNames()
    assert silver.first()["hl_spread"] is None and silver.first()["oc_change"] == 1.0


@pytest.mark.parametrize(
    ("size", "text"),
    [
        (None, "0 B"),
        (0, "0 B"),
        (512, "512.0 B"),
        (-5, "-5.0 B"),
        (1023, "1023.0 B"),
        (1024, "1.0 KB"),
        (1280, "1.2 KB"),
        (1792, "1.8 KB"),
        (5 * 1024**3, "5.0 GB"),
        (2**50, "1024.0 TB"),
    ],
)
def test_human_bytes(spark, size, text):
    frame = spark.createDataFrame([(size,)], "n long")
    assert frame.select(human_bytes(F.col("n"))).first()[0] == text


@pytest.mark.parametrize(
    ("value", "number"),
    [("x", 0.0), (None, 0.0), ("nan", 0.0), ("2.5", 2.5), ("", 0.0), ("inf", math.inf)],
)
def test_number_or_zero(spark, value, number):
    frame = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", T.StringType())]))
    assert frame.select(number_or_zero(F.col("v"))).first()[0] == number


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("1.5", 1.5),
        (" -2e3 ", -2000.0),
        (".5", 0.5),
        ("7.", 7.0),
        ("1d", 0.0),
        ("1.5f", 0.0),
        ("0x1p3", 0.0),
        ("0x10", 0.0),
        ("1_000", 0.0),
        ("", 0.0),
        ("nan", 0.0),
        ("inf", float("inf")),
        (None, 0.0),
    ],
)
def test_text_that_is_no_number_is_zero(spark, text, number):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(number_or_zero(F.col("t"))).first()[0] == number
