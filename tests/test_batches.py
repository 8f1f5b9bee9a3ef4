"""Tables of batches: what counts, folding, and the order of arrival through all of it."""

import json
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickwright.functions.prices import with_spread
from tickwright.operators.rows import numbered
from tickwright.operators.training import label_next_close
from tickwright.schemas import ARRIVAL, SILVER, STATS, TICK
from tickwright.sinks import batches as sinks
from tickwright.sources import batches, files, tables
from tickwright.sources.ticks import tick_stream, topic_position
from tickwright.streaming import jobs

T0 = datetime(2024, 1, 1)


def changed(spark, batch, windows):
    """A batch that changed the named windows; the number of ticks tells which batch it was."""
    rows = [
        (T0 + timedelta(seconds=10 * w), T0 + timedelta(seconds=10 * w + 10), "A", 1.0, 2.0, 1.5, None, 1.0, batch)
        for w in windows
    ]
    return spark.createDataFrame(rows, STATS)


def observed(spark, where):
    got = tables.read_stats_changes(spark, where).collect()
    return {int((r["window_start"] - T0).total_seconds()) // 10: r["n_obs"] for r in got}


def log_only(spark, where, ids, df):
    """Many batches at once: one folder each, as write_batch leaves it, written by one job."""
    df.withColumn("own", F.col("batch_id")).write.partitionBy("own").parquet(batches.folder(where, ""))
    for i in ids:
        files.mark(spark, batches.Entry(i, 0, f"own={i}").marker(where))


def test_a_thousand_and_one_batches_are_read_from_few_folders(spark, path):
    """Each batch changes its own window and the one before it; readers open base and unfolded batches only."""
    n, where = 1001, path("changes")
    rows = spark.range(n).select(
        F.explode(F.array(F.col("id") - 1, F.col("id"))).alias("w"), F.col("id").alias("batch_id")
    ).where("w >= 0")
    start = F.timestamp_micros(F.lit(1704067200000000) + F.col("w") * 10_000_000)
    shape = rows.select(
        start.alias("window_start"), (start + F.expr("INTERVAL 10 SECONDS")).alias("window_end"), F.lit("A").alias("symbol"),
        *[F.lit(1.0).alias(c) for c in ("min_close", "max_close", "avg_close", "var_close", "avg_volume")],
        F.col("batch_id").alias("n_obs"), "batch_id",
    ).repartition(1)
    log_only(spark, where, range(n), shape)
    made = sinks.fold(spark, where, tables.latest_changes, fan=100)
    assert [(s.level, s.first, s.last) for s in made] == [(1, 100 * i, 100 * i + 99) for i in range(10)]
    made = sinks.fold(spark, where, tables.latest_changes, fan=10)
    assert [(s.level, s.first, s.last) for s in made] == [(2, 0, 999)]
    live = batches.live(spark, where).folders
    assert len(live) == 2
    assert observed(spark, where) == {w: min(w + 1, n - 1) for w in range(n)}
    opened = {f.rpartition("/")[0].rpartition("/")[2] for f in tables.read_stats_changes(spark, where).inputFiles()}
    assert opened == {f.rpartition("/")[2] for f in live}
    # one row per window is left of two
    assert spark.read.parquet(live[0]).count() == 1000


def test_a_fold_that_is_cut_off_changes_nothing(spark, path, monkeypatch):
    where = path("changes")
    for batch in range(6):
        sinks.write_batch(changed(spark, batch, [batch, batch + 1]), where, batch)
    before, folders = observed(spark, where), batches.live(spark, where).folders

    def lost(*_):
        raise OSError("the driver is gone")

    with monkeypatch.context() as cut:
        cut.setattr(files, "mark", lost)
        with pytest.raises(OSError):
            sinks.fold(spark, where, tables.latest_changes, fan=3)
    assert batches.live(spark, where).folders == folders and observed(spark, where) == before
    sinks.fold(spark, where, tables.latest_changes, fan=3)
    assert len(batches.live(spark, where).folders) == 4 and observed(spark, where) == before
    # the folder of the lost try and the folded ones go once nobody reads them any more
    assert sinks.vacuum(spark, where) == []
    assert len(sinks.vacuum(spark, where, grace=-60)) == 1 + 3
    assert observed(spark, where) == before


def test_batches_go_on_after_folding_but_folded_ones_stay(spark, path):
    where = path("changes")
    for batch in range(9):
        sinks.write_batch(changed(spark, batch, [0, batch]), where, batch)
        sinks.fold(spark, where, tables.latest_changes, fan=2)
    # the newest batch is not folded and can be repeated
    sinks.write_batch(changed(spark, 80, [0]), where, 8)
    assert observed(spark, where)[0] == 80 and 8 not in observed(spark, where)
    with pytest.raises(ValueError, match="folded"):
        sinks.write_batch(changed(spark, 3, [0]), where, 3)
    whole = batches.segments(spark, where)
    assert [(s.level, s.first, s.last) for s in whole] == [(3, 0, 7)]
    assert {i: n for i, n in observed(spark, where).items() if i} == {w: w for w in range(1, 8)}


def test_readers_beside_a_repeated_batch_miss_nothing(spark, path):
    """While a batch is written again and again, every read sees one of its tries whole."""
    where = path("p")
    frame = with_spread(spark.createDataFrame([(T0, "A", 1.0, 2.0, 0.5, 1.0, 1.0, "s")] * 20, TICK))
    sinks.write_batch(frame, where, 0)
    sinks.write_batch(frame, where, 1)
    done, seen = threading.Event(), []

    def read():
        while not done.is_set():
            seen.append(tables.read_predictions(spark, where).count())

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for _ in range(6):
            sinks.write_batch(frame, where, 1)
    finally:
        done.set()
        reader.join()
    assert seen and set(seen) == {40}
    assert len(sinks.vacuum(spark, where, grace=-60)) == 6


def message(second, close):
    at = (T0 + timedelta(seconds=second)).isoformat() + "+00:00"
    values = {"event_time": at, "symbol": "A", "open": 1.0, "high": 2.0, "low": 0.5, "close": close}
    return json.dumps({**values, "volume": 1.0, "source": "s"})


def test_ties_keep_their_order_of_arrival_when_files_are_rewritten(spark, path):
    """Ticks of one instant follow each other as their lines do, before and after folding."""
    closes = [float(c) for c in (5, 3, 9, 1, 7, 2, 8, 4, 6, 0, 15, 13, 19, 11, 17, 12)]
    for i in range(4):
        lines = [message(1, c) for c in closes[4 * i : 4 * i + 4]]
        files.write_text(spark, path(f"in/{i}"), "\n".join(lines) + "\n")
    stream = tick_stream(spark, "json", path("in"), max_per_trigger=1)
    tables_at = path("bronze"), path("silver")
    jobs.start_bronze_and_silver(stream, *tables_at, path("c"), jobs.AVAILABLE_NOW, folded=100).awaitTermination()

    def labels():
        silver = tables.read_silver(spark, path("silver"), row_id="id")
        labelled = label_next_close(silver, "id")
        return {r["close"]: r["next_close"] for r in labelled.collect()}

    expected = dict(zip(closes, [*closes[1:], None]))
    assert labels() == expected
    assert sinks.fold(spark, path("silver"), fan=3) and len(batches.live(spark, path("silver")).folders) == 2
    assert labels() == expected
    # a copy in other files, in another order
    stored = spark.read.parquet(*batches.live(spark, path("silver")).folders)
    stored.orderBy(F.rand(1)).repartition(5).write.parquet(path("copy"))
    silver = tables.read_tolerant(spark, path("copy"), SILVER, "id")
    labelled = label_next_close(silver, "id", rows_per_slice=5)
    assert {r["close"]: r["next_close"] for r in labelled.collect()} == expected
    assert tables.read_silver(spark, path("silver")).columns == SILVER.fieldNames()


def test_predictions_keep_their_place_of_arrival(spark, path):
    from tickwright.operators.regression import LinearModel

    closes = [4.0, 1.0, 3.0, 2.0, 9.0, 8.0]
    for i in range(2):
        files.write_text(spark, path(f"in/{i}"), "\n".join(message(1, c) for c in closes[3 * i : 3 * i + 3]) + "\n")
    stream = tick_stream(spark, "json", path("in"), max_per_trigger=1)
    model = LinearModel(["close"], [1.0], 0.0)
    jobs.start_scoring(stream, model, path("p"), path("c"), jobs.AVAILABLE_NOW).awaitTermination()
    found = tables.read_predictions(spark, path("p"), row_id="id").orderBy("id").collect()
    assert [r["close"] for r in found] == closes


def test_a_topics_messages_are_ordered_by_their_offsets(spark):
    frame = spark.createDataFrame([(0, 5), (0, 2**47), (1, 0), (1, 7)], "partition int, offset long")
    found = [r[0] for r in frame.select(topic_position()).collect()]
    assert found == sorted(found) and len(set(found)) == 4
    for wrong in ((0, 2**48), (2**14, 0)):
        with pytest.raises(Exception, match="no position"):
            spark.createDataFrame([wrong], "partition int, offset long").select(topic_position()).collect()


def test_numbers_rise_over_rows_and_batches(spark):
    frame = spark.range(1000, numPartitions=7).persist()
    first = {r["id"]: r[ARRIVAL] for r in numbered(frame, ARRIVAL, 3).collect()}
    assert [first[i] for i in range(1000)] == [(3 << 36) + i for i in range(1000)]
    assert numbered(frame.limit(0), ARRIVAL, 4).count() == 0
    frame.unpersist()
