import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickwright.functions.predictions import unify_prediction
from tickwright.functions.prices import silver_features
from tickwright.operators import evaluation, scoring
from tickwright.operators.regression import LinearModel
from tickwright.schemas import FEATURES, TICK

T0 = datetime(2024, 1, 1)
MODEL = LinearModel(FEATURES, [0.0, 0.0, 0.0, 1.0, 0.0, 0.0], 0.5)


def errors(spark, misses):
    return spark.createDataFrame([(m,) for m in misses], "abs_error double")


def test_fill_features_overwrites_gaps(spark):
    rows = [("x", math.nan, None, "2.5")]
    frame = spark.createDataFrame(rows, "open string, high double, low double, close string")
    filled = scoring.fill_features(frame).select(*FEATURES).first()
    assert tuple(filled) == (0.0, 0.0, 0.0, 2.5, 0.0, 0.0)


def test_infinite_feature_has_no_prediction(spark):
    frame = scoring.fill_features(
        spark.createDataFrame([(math.inf,), (1.0,)], "close double")
    )
    got = [r["pred_next_close"] for r in scoring.score(frame, MODEL).orderBy("close").collect()]
    assert got == [1.5, None]


def test_score_ticks_names_the_target(spark):
    row = (T0, "A", 1.0, 2.0, 0.5, 2.0, 1.0, "s")
    scored = scoring.score_ticks(silver_features(spark.createDataFrame([row], TICK)), MODEL)
    assert scored.first()["pred_next_close"] == 2.5
    assert scored.first()["prediction_target"] == "next_close"


def test_legacy_column_only_stands_in(spark):
    both = spark.createDataFrame([(1.0, 2.0)], "pred_close double, pred_next_close double")
    assert unify_prediction(both).first()["pred_next_close"] == 2.0
    assert unify_prediction(both.drop("pred_next_close")).first()["pred_next_close"] == 1.0


def test_errors_keep_a_given_actual_and_drop_gaps(spark):
    rows = [(1, T0, "A", 1.0, 5.0, 7.0), (2, T0, "A", 1.0, None, 7.0), (3, T0, "A", 1.0, 5.0, None)]
    schema = "tie long, event_time timestamp, symbol string, close double, {} double, {} double"
    frame = spark.createDataFrame(rows, schema.format("pred_next_close", "actual_next_close"))
    got = scoring.with_errors(frame, "tie").collect()
    assert [(r["tie"], r["abs_error"]) for r in got] == [(1, 2.0)]


def test_demo_takes_the_latest_rows_and_tags_them(spark):
    rows = [
        (T0 + timedelta(seconds=i), "A", 1.0, 2.0, 0.5, float(i), 1.0, "s") for i in range(20)
    ]
    silver = silver_features(spark.createDataFrame(rows, TICK))
    silver = silver.withColumn("tie", F.col("close").cast("long"))
    got = scoring.demo_predictions(silver, MODEL, "tie", n=5).orderBy("tie").collect()
    assert [(r["tie"], r["actual_next_close"], r["abs_error"]) for r in got] == [
        (i, i + 1.0, 0.5) for i in range(15, 19)
    ]
    assert {r["source_mode"] for r in got} == {"demo_from_silver"}


def test_demo_adds_missing_features_but_fills_none(spark):
    rows = [(i, T0 + timedelta(seconds=i), "A", 1.0, None if i == 1 else 1.0) for i in range(3)]
    frame = spark.createDataFrame(
        rows, "tie long, event_time timestamp, symbol string, close double, volume double"
    )
    got = scoring.demo_predictions(frame, MODEL, "tie").collect()
    assert [r["tie"] for r in got] == [0]


def test_view_falls_back_only_without_predictions(spark):
    some = spark.createDataFrame([(1.0,)], "abs_error double")
    demo = some.withColumn("source_mode", F.lit("demo_from_silver"))
    assert scoring.choose_view(some, demo).first()["source_mode"] == "stream"
    assert scoring.choose_view(some.limit(0), demo).first()["source_mode"] == "demo_from_silver"


def test_online_mae_of_nothing_is_zero(spark):
    assert evaluation.online_mae(errors(spark, [1.0, 3.0])).first()["mae"] == 2.0
    assert evaluation.online_mae(errors(spark, [])).first()["mae"] == 0.0


@pytest.mark.parametrize(
    ("misses", "bins"),
    [
        ([0.0, 1.0, 29.9, 30.0, None], {0: 1, 1: 1, 29: 2}),
        ([4.0, 4.0], {0: 2}),
        ([], {}),
    ],
)
def test_histogram(spark, misses, bins):
    found = evaluation.error_histogram(errors(spark, misses)).collect()
    assert {r["bin"]: r["n"] for r in found} == bins


def test_latest_batches_by_id(spark):
    rows = [(b, v) for b in range(40) for v in (1, 2)]
    frame = spark.createDataFrame(rows, "batch_id int, v int")
    got = evaluation.latest_batches(frame)
    assert sorted({r["batch_id"] for r in got.collect()}) == list(range(10, 40))
    assert got.count() == 60


def test_latest_runs_round_half_even(spark):
    rows = [(T0 + timedelta(days=i), f"c{i}", 0.0625 + i, 0) for i in range(9)]
    schema = "timestamp_utc timestamp_ntz, command string, elapsed_seconds double, return_code int"
    got = evaluation.latest_runs(spark.createDataFrame(rows, schema)).collect()
    assert [r["command"] for r in got] == [f"c{i}" for i in range(3, 9)]
    assert got[0]["elapsed_seconds"] == 3.062


def test_unpivot_gives_two_rows_per_tick(spark):
    schema = "tie long, event_time timestamp, symbol string, actual_next_close double, "
    frame = spark.createDataFrame([(1, T0, "A", 2.0, 3.0)], schema + "pred_next_close double")
    got = evaluation.predicted_and_actual(frame, "tie").collect()
    assert sorted((r["series"], r["price"]) for r in got) == [
        ("actual_next_close", 2.0),
        ("pred_next_close", 3.0),
    ]


def test_the_histogram_runs_its_input_once(spark):
    """The errors are computed by one job, whatever range and bins need."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    values = spark.range(100).select(F.sqrt("id").alias("abs_error")).mapInPandas(counted, "abs_error double")
    found = {r["bin"]: r["n"] for r in evaluation.error_histogram(values).collect()}
    assert sum(found.values()) == 100 and seen.value == 100
    width = 99**0.5 / 30
    expected = {}
    for i in range(100):
        b = min(29, int(i**0.5 / width))
        expected[b] = expected.get(b, 0) + 1
    assert found == expected
