"""Schemas of every table the engine reads or writes."""

from pyspark.sql import types as T

# Column names, types and order are part of the wire and table formats.
TICK = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("source", T.StringType()),
    ]
)

SILVER = T.StructType(
    TICK.fields
    + [
        T.StructField("range_bucket", T.StringType()),
        T.StructField("hl_spread", T.DoubleType()),
        T.StructField("oc_change", T.DoubleType()),
    ]
)

STATS = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("min_close", T.DoubleType()),
        T.StructField("max_close", T.DoubleType()),
        T.StructField("avg_close", T.DoubleType()),
        T.StructField("var_close", T.DoubleType()),
        T.StructField("avg_volume", T.DoubleType()),
        T.StructField("n_obs", T.LongType()),
    ]
)

HISTORY = T.StructType(TICK.fields + [T.StructField("hl_spread", T.DoubleType())])

PREDICTIONS = T.StructType(
    HISTORY.fields
    + [
        T.StructField("pred_next_close", T.DoubleType()),
        T.StructField("prediction_target", T.StringType()),
        T.StructField("batch_id", T.IntegerType()),
    ]
)

#: An integer beside the columns of stored ticks: where each arrived, rising with the order of arrival.
ARRIVAL = "arrival"

FEATURES = ["open", "high", "low", "close", "volume", "hl_spread"]
TARGET = "next_close"

PROGRESS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("runId", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("batchId", T.LongType()),
        T.StructField("numInputRows", T.LongType()),
        T.StructField("inputRowsPerSecond", T.DoubleType()),
        T.StructField("processedRowsPerSecond", T.DoubleType()),
        T.StructField(
            "durationMs", T.StructType([T.StructField("triggerExecution", T.LongType())])
        ),
        T.StructField(
            "stateOperators",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("numRowsTotal", T.LongType()),
                        T.StructField("numRowsUpdated", T.LongType()),
                        T.StructField("numRowsDroppedByWatermark", T.LongType()),
                        T.StructField("memoryUsedBytes", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("timestamp_utc", T.TimestampNTZType()),
        T.StructField("command", T.StringType()),
        T.StructField("elapsed_seconds", T.DoubleType()),
        T.StructField("return_code", T.IntegerType()),
    ]
)

MODEL = T.StructType(
    [
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("coefficients", T.ArrayType(T.DoubleType())),
        T.StructField("intercept", T.DoubleType()),
        T.StructField("target", T.StringType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("n_train", T.LongType()),
        T.StructField("n_test", T.LongType()),
    ]
)

# The keys of a daily-series payload document.
PAYLOAD_SERIES = "Time Series (Daily)"
PAYLOAD_META = "Meta Data"
PAYLOAD_SYMBOL = "2. Symbol"
PAYLOAD_FIELDS = {
    "open": "1. open",
    "high": "2. high",
    "low": "3. low",
    "close": "4. close",
    "volume": "5. volume",
}
PAYLOAD = T.StructType(
    [
        T.StructField(
            PAYLOAD_META, T.StructType([T.StructField(PAYLOAD_SYMBOL, T.StringType())])
        ),
        T.StructField(
            PAYLOAD_SERIES,
            T.MapType(
                T.StringType(),
                T.StructType(
                    [T.StructField(name, T.StringType()) for name in PAYLOAD_FIELDS.values()]
                ),
            ),
        ),
    ]
)
