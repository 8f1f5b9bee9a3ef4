import json
import pathlib
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickwright.functions.prices import silver_features, with_spread
from tickwright.operators.windows import window_stats
from tickwright.schemas import HISTORY, PREDICTIONS, PROGRESS, RUN_LOG, SILVER, STATS, TICK
from tickwright.sinks import tables as sinks
from tickwright.sinks.batches import write_batch
from tickwright.sinks.messages import publish
from tickwright.sources import batches, files, logs, payload, tables
from tickwright.sources.ticks import message_stream, tick_stream

T0 = datetime(2024, 1, 1)


def ticks(spark, n, first=0):
    rows = [
        (T0 + timedelta(seconds=first + i), "A", 1.0, 2.0, 0.5, float(first + i), 1.0, "s")
        for i in range(n)
    ]
    return spark.createDataFrame(rows, TICK)


# tolerant tables


def test_missing_folder_is_an_empty_table(spark, path):
    assert tables.read_silver(spark, path("nothing")).schema.fieldNames() == SILVER.fieldNames()
    assert tables.read_silver(spark, path("nothing"), row_id="id").count() == 0


def test_zero_byte_and_damaged_files_are_skipped(spark, path):
    silver_features(ticks(spark, 7)).write.parquet(path("silver/day=1"))
    files.write_text(spark, path("silver/zero.parquet"), "")
    files.write_text(spark, path("silver/bad.parquet"), "no parquet at all")
    files.write_text(spark, path("silver/notes.txt"), "no table")
    assert tables.read_silver(spark, path("silver")).count() == 7


def test_single_file_can_be_read(spark, path):
    silver_features(ticks(spark, 3)).coalesce(1).write.parquet(path("silver"))
    (part,) = [n for n, _ in files.children(spark, path("silver")) if n.endswith(".parquet")]
    assert tables.read_silver(spark, path(f"silver/{part}")).count() == 3


def test_row_ids_are_unique_and_stable(spark, path):
    silver_features(ticks(spark, 200)).repartition(3).write.parquet(path("silver"))

    def ids():
        found = tables.read_silver(spark, path("silver"), row_id="id").collect()
        return {r["close"]: r["id"] for r in found}

    first = ids()
    assert len(set(first.values())) == 200 and first == ids()


# snapshots and changes


def stats(spark, n, first=0):
    return window_stats(ticks(spark, n, first))


def test_snapshot_is_replaced_and_old_versions_go_by_age(spark, path):
    order = ["window_start", "symbol"]
    for n in (10, 20, 30, 40):
        assert sinks.write_snapshot(stats(spark, n), path("stats"), order)
    # readers of any of them may still be busy
    assert tables.snapshot_versions(spark, path("stats")) == [0, 1, 2, 3]
    assert sinks.write_snapshot(stats(spark, 50), path("stats"), order, grace=0)
    assert tables.snapshot_versions(spark, path("stats")) == [4]
    got = [r["window_start"] for r in tables.read_stats(spark, path("stats")).collect()]
    assert got == [T0 + timedelta(seconds=10 * i) for i in range(5)]


def test_empty_batch_leaves_the_snapshot(spark, path):
    sinks.write_snapshot(stats(spark, 10), path("stats"), ["symbol"])
    assert not sinks.write_snapshot(stats(spark, 0), path("stats"), ["symbol"])
    assert tables.read_stats(spark, path("stats")).count() == 1


def test_unfinished_version_is_not_read(spark, path):
    sinks.write_snapshot(stats(spark, 10), path("stats"), ["symbol"])
    stats(spark, 50).write.parquet(path("stats/version=0000000001"))
    files.drop_folder(spark, path("stats/version=0000000001/_SUCCESS"))
    assert tables.read_stats(spark, path("stats")).count() == 1
    sinks.write_snapshot(stats(spark, 30), path("stats"), ["symbol"])
    assert tables.read_stats(spark, path("stats")).count() == 3


def test_stats_fall_back_to_the_newest_part_files(spark, path):
    assert tables.read_stats(spark, path("stats")).schema == STATS
    for i in range(4):
        folder = path(f"one{i}")
        stats(spark, 10, 10 * i).coalesce(1).write.parquet(folder)
        (part,) = [n for n, _ in files.children(spark, folder) if n.endswith(".parquet")]
        with open(f"{folder}/{part}", "rb") as source:
            data = source.read()
        target = path("stats") + f"/part-{i}.parquet"
        files.write_text(spark, path("stats/marker.txt"), "") if i == 0 else None
        with open(target, "wb") as out:
            out.write(data)
    files.write_text(spark, path("stats/part-9.parquet"), "")
    got = tables.read_stats(spark, path("stats"), n_files=3)
    assert sorted(r["min_close"] for r in got.collect()) == [10.0, 20.0, 30.0]


def test_last_change_of_a_window_wins(spark, path):
    assert tables.read_stats_changes(spark, path("changes")).count() == 0
    write_batch(stats(spark, 5), path("changes"), 9)
    write_batch(stats(spark, 20), path("changes"), 10)
    write_batch(stats(spark, 0), path("changes"), 11)
    write_batch(stats(spark, 20), path("changes"), 10)
    got = tables.read_stats_changes(spark, path("changes"))
    assert got.columns == STATS.fieldNames()
    assert sorted((r["min_close"], r["n_obs"]) for r in got.collect()) == [(0.0, 10), (10.0, 10)]


# predictions


def scored(spark, n, first=0, column="pred_next_close"):
    return with_spread(ticks(spark, n, first)).select(
        "*", F.lit(1.0).alias(column), F.lit("next_close").alias("prediction_target")
    )


def test_only_the_newest_batches_are_read(spark, path):
    assert tables.read_predictions(spark, path("p")).schema == PREDICTIONS
    for batch in range(5):
        write_batch(scored(spark, 2, 2 * batch), path("p"), batch)
    write_batch(scored(spark, 2, 8), path("p"), 4)  # the same batch again
    got = tables.read_predictions(spark, path("p"), 3, row_id="id")
    assert got.columns == [*PREDICTIONS.fieldNames(), "id"]
    assert sorted((r["batch_id"], r["close"]) for r in got.collect()) == [
        (2, 4.0), (2, 5.0), (3, 6.0), (3, 7.0), (4, 8.0), (4, 9.0)
    ]
    older = batches.entries(spark, path("p"))[1].attempt
    assert all(older not in name for name in got.inputFiles())
    assert tables.read_predictions(spark, path("p"), None).count() == 10


def test_newest_batches_reach_over_groups(spark, path):
    ids = [0, 7, 998, 999, 1000, 2500]
    for batch in ids:
        files.mark(spark, batches.Entry(batch, 0, f"try{batch}").marker(path("p")))
    # tries without an entry are not there yet
    files.write_text(spark, batches.folder(path("p"), "try2501") + "/part", "")

    def newest(n):
        return list(batches.entries(spark, path("p"), newest=n))

    assert newest(1) == [2500] and newest(4) == [998, 999, 1000, 2500] and newest(30) == ids
    assert list(batches.entries(spark, path("p"), after=999)) == [1000, 2500]


def test_legacy_predictions_are_offered_under_the_new_name(spark, path):
    write_batch(scored(spark, 2, column="pred_close"), path("p"), 0)
    (entry,) = batches.entries(spark, path("p")).values()
    files.write_text(spark, batches.folder(path("p"), entry.attempt) + "/bad.parquet", "bad")
    assert [r["pred_next_close"] for r in tables.read_predictions(spark, path("p")).collect()] == [
        1.0,
        1.0,
    ]


def test_damaged_files_are_never_opened(spark, path):
    """However many files there are, the driver asks for few things; a damaged file is left out unopened."""
    with_spread(ticks(spark, 60)).repartition(12).write.parquet(path("t"))
    for name, text in (("zero", ""), ("odd name=1%", "no parquet, but long enough")):
        files.write_text(spark, f"{path('t')}/{name}.parquet", text)
    table = tables.read_tolerant(spark, path("t"), HISTORY)
    assert table.count() == 60 and table.where("close >= 30").count() == 30
    calls = []
    listed = files.below
    files.below = lambda *a: calls.append(a) or listed(*a)
    try:
        assert len(tables.damaged_files(spark, [path("t")])) == 1 and not calls
    finally:
        files.below = listed


def test_a_file_that_cannot_be_read_to_its_end_is_an_error(spark, path):
    """Damage between a file's marks must not pass for a shorter table."""
    with_spread(ticks(spark, 1000)).coalesce(1).write.parquet(path("t"))
    part = next(p for p, _ in files.below(spark, path("t")) if p.endswith(".parquet"))
    place = pathlib.Path(part.removeprefix("file:"))
    data = bytearray(place.read_bytes())
    data[10:400] = b"\0" * 390
    place.with_name(f".{place.name}.crc").unlink(missing_ok=True)
    place.write_bytes(data)
    with pytest.raises(Exception):
        tables.read_tolerant(spark, path("t"), HISTORY).collect()


def test_damaged_files_are_named(spark, path):
    with_spread(ticks(spark, 10)).write.parquet(path("t"))
    with_spread(ticks(spark, 10)).limit(0).write.mode("append").parquet(path("t"))
    for name, text in (("zero", ""), ("short", "PAR1"), ("odd name=1%", "no parquet, but long enough")):
        files.write_text(spark, f"{path('t')}/{name}.parquet", text)
    found = {p.rpartition("/")[2] for p in tables.damaged_files(spark, [path("t")])}
    assert found == {"short.parquet", "odd name=1%.parquet"}
    assert tables.read_tolerant(spark, path("t"), HISTORY).count() == 10


def test_statistics_of_all_part_files_or_the_newest(spark, path):
    stats = window_stats(ticks(spark, 1000), "10 seconds")
    stats.repartition(40).write.parquet(path("stats"))
    assert tables.read_stats(spark, path("stats")).count() == stats.count()
    later = stats.limit(1).withColumn("n_obs", F.lit(-1).cast("long"))
    time.sleep(1.1)
    later.coalesce(1).write.mode("append").parquet(path("stats"))
    assert [r.n_obs for r in tables.read_stats(spark, path("stats"), n_files=1).collect()] == [-1]


def test_a_repeated_batch_takes_the_place_of_the_first(spark, path):
    assert write_batch(scored(spark, 2), path("p"), 5) == 2
    assert write_batch(scored(spark, 3), path("p"), 5) == 3
    assert tables.read_predictions(spark, path("p")).count() == 3
    assert write_batch(scored(spark, 3).limit(0), path("p"), 5) == 0
    assert batches.entries(spark, path("p"), newest=9) == {}
    assert tables.read_predictions(spark, path("p")).count() == 0


# history and payloads


def test_history_is_built_once_and_again_when_short(spark, path):
    calls = []

    def build(n):
        def make():
            calls.append(n)
            return with_spread(ticks(spark, n))

        return make

    assert sinks.cached_history(spark, path("h"), build(50), min_rows=60).count() == 50
    assert sinks.cached_history(spark, path("h"), build(70), min_rows=60).count() == 70
    got = sinks.cached_history(spark, path("h"), build(80), min_rows=60)
    assert got.count() == 70 and got.columns == HISTORY.fieldNames() and calls == [50, 70]


def quote(close, opened="1.0"):
    values = {"1. open": opened, "2. high": "3", "3. low": "0.5", "4. close": close}
    return {**values, "5. volume": "10"}


def test_payload_days_become_ticks(spark):
    documents = [
        {
            "Meta Data": {"2. Symbol": "IBM"},
            "Time Series (Daily)": {"2024-01-02": quote("2.5"), "2024-01-03": quote("x")},
        },
        {"Information": "no series here"},
    ]
    texts = [json.dumps(d) for d in documents] + ["junk"]
    frame = spark.createDataFrame([(t,) for t in texts], "payload string")
    got = payload.flatten_daily(frame).orderBy("event_time")
    assert got.columns == TICK.fieldNames()
    first, second = got.collect()
    assert first["event_time"] == datetime(2024, 1, 2) and first["symbol"] == "IBM"
    assert (first["close"], first["volume"], first["source"]) == (2.5, 10.0, "alphavantage_daily")
    assert second["close"] is None and second["open"] == 1.0
    nameless = frame.select(F.regexp_replace("payload", "2. Symbol", "x").alias("payload"))
    named = payload.flatten_daily(nameless, F.lit("XYZ"))
    assert {r["symbol"] for r in named.collect()} == {"XYZ"}
    assert {r["symbol"] for r in payload.flatten_daily(frame, F.lit("XYZ")).collect()} == {"IBM"}


def test_payload_files(spark, path):
    document = {"Time Series (Daily)": {"2024-01-02": quote("2")}}
    files.write_text(spark, path("docs/a.json"), json.dumps(document, indent=2))
    assert payload.flatten_daily(payload.read_payloads(spark, path("docs"))).count() == 1


# logs


def test_run_log(spark, path):
    assert logs.read_run_log(spark, path("runs.csv")).schema == RUN_LOG
    text = (
        "timestamp_utc,command,elapsed_seconds,return_code\n"
        "2024-01-01T00:00:00.123456,python -m x,1.5,0\n"
        "2024-01-02T00:00:00,python -m y,oops,1\n"
    )
    files.write_text(spark, path("runs.csv"), text)
    first, second = logs.read_run_log(spark, path("runs.csv")).collect()
    assert first["timestamp_utc"] == datetime(2024, 1, 1, 0, 0, 0, 123456)
    assert second["elapsed_seconds"] is None and second["return_code"] == 1


def test_progress_figures_default_to_zero(spark, path):
    assert logs.read_progress(spark, path("progress")).schema == PROGRESS
    old = {"name": "q", "batchId": 1, "timestamp": "2024-01-01T00:00:00Z", "numInputRows": 3}
    new = {**old, "batchId": 2, "timestamp": "2024-01-01T00:00:01Z", "inputRowsPerSecond": 2.5}
    new["stateOperators"] = [{"numRowsTotal": 4, "memoryUsedBytes": 2048}]
    unnamed = {"batchId": 0, "timestamp": "2024-01-01T00:00:00Z", "stateOperators": []}
    for i, doc in enumerate([old, new, unnamed]):
        files.write_text(spark, path(f"progress/q/{i}.json"), json.dumps(doc))
    files.write_text(spark, path("progress/q/broken.json"), "{oops")
    last = logs.latest_progress(logs.read_progress(spark, path("progress")))
    got = {r["name"]: r for r in logs.progress_metrics(last).collect()}
    assert set(got) == {"q", "unnamed_query"}
    row = got["q"]
    assert (row["batch_id"], row["input_rate"], row["state_rows"]) == (2, 2.5, 4)
    assert (row["state_memory"], row["dropped_rows"], row["batch_ms"]) == ("2.0 KB", 0, 0)
    assert got["unnamed_query"]["state_memory"] == "0 B"


# message sources


def test_unknown_kinds_are_refused(spark, path):
    with pytest.raises(ValueError, match="message source"):
        message_stream(spark, "carrier pigeon", "x")
    with pytest.raises(ValueError, match="starting point"):
        message_stream(spark, "json", "x", starting="yesterday")
    with pytest.raises(ValueError, match="message sink"):
        publish(ticks(spark, 1), "carrier pigeon", "x")


def test_topic_needs_the_connector_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        tick_stream(spark, "kafka", "market_ticks", servers="localhost:9092")
