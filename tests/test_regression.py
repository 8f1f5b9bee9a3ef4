from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tickwright.operators import regression
from tickwright.schemas import FEATURES, TARGET

SCHEMA = "tie long, symbol string, event_time timestamp, " + ", ".join(
    f"{c} double" for c in [*FEATURES, TARGET]
)


def tick_like(n=400, constant_spread=False, volume=1000.0):
    """A random walk with open = previous close, and a spread that is high - low."""
    rng = np.random.default_rng(7)
    close = 100 + np.cumsum(rng.normal(0.02, 0.35, n + 1))
    opened, close = close[:-1], close[1:]
    if constant_spread:
        opened = close - 0.4
        high, low = close + 0.7, close - 0.8
    else:
        high = np.maximum(opened, close) + rng.random(n) * 0.2
        low = np.minimum(opened, close) - rng.random(n) * 0.2
    traded = rng.integers(100, 5000, n) * volume
    target = np.append(close[1:], close[-1])
    data = np.column_stack([opened, high, low, close, traded, high - low, target])
    start = datetime(2024, 1, 1)
    return [
        (i, "A", start + timedelta(seconds=i), *map(float, row)) for i, row in enumerate(data)
    ]


def least_norm(rows):
    data = np.array([r[3:] for r in rows])
    x, y = data[:, :-1], data[:, -1]
    weights = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=None)[0]
    return weights, y.mean() - x.mean(0) @ weights, x


@pytest.mark.parametrize("constant_spread", [False, True])
@pytest.mark.parametrize("volume", [1e-3, 1.0, 1e6])
def test_fit_is_the_least_norm_solution(spark, constant_spread, volume):
    rows = tick_like(constant_spread=constant_spread, volume=volume)
    model = regression.fit(spark.createDataFrame(rows, SCHEMA))
    weights, intercept, x = least_norm(rows)
    expected = x @ weights + intercept
    got = x @ np.array(model.coefficients) + model.intercept
    assert np.abs(got - expected).max() < 1e-6
    outside = x.copy()
    outside[:, -1] = 0.0  # a spread that does not fit high and low, as filled rows have
    gap = outside @ (np.array(model.coefficients) - weights) + model.intercept - intercept
    assert np.abs(gap).max() < 1e-4


@pytest.mark.parametrize("volume", [1e-3, 1e6])
def test_a_refit_from_stored_moments_is_the_fit_of_all_rows(spark, path, volume):
    """Batches of very different size and level, one of a single row, one without any."""
    rows = tick_like(volume=volume)
    frame = spark.createDataFrame(rows, SCHEMA)
    sizes = [1, 7, 0, 150, 242]
    first = 0
    for batch, size in enumerate(sizes):
        own = frame.where(F.col("tie").between(first, first + size - 1))
        regression.moments(own).withColumn("batch_id", F.lit(batch)).write.parquet(f"{path('moments')}/{batch}")
        first += size
    stored = spark.read.parquet(*[f"{path('moments')}/{b}" for b in range(len(sizes))])
    weights, intercept, x = least_norm(rows)
    expected = x @ weights + intercept
    again = regression.refit(stored)
    assert np.abs(x @ np.array(again.coefficients) + again.intercept - expected).max() < 1e-6
    grouped = regression.moments(frame.withColumn("part", F.col("tie") % 7), by=("part",))
    assert grouped.count() == 7
    other = regression.refit(grouped)
    assert np.abs(x @ np.array(other.coefficients) + other.intercept - expected).max() < 1e-6
    with pytest.raises(ValueError, match="no rows"):
        regression.refit(stored.where("n = 0"))


def test_the_fit_takes_one_pass(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    frame = spark.createDataFrame(tick_like(), SCHEMA)
    regression.fit(frame.mapInPandas(counted, SCHEMA))
    assert seen.value == frame.count()


def test_predictions_agree_with_the_library_solver(spark):
    frame = spark.createDataFrame(tick_like(), SCHEMA)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(frame)
    library = LinearRegression(labelCol=TARGET, regParam=0.0, tol=1e-12).fit(vectors)
    other = {r["tie"]: r["prediction"] for r in library.transform(vectors).collect()}
    ours = regression.predict(regression.fit(frame), frame).collect()
    assert max(abs(r["prediction"] - other[r["tie"]]) for r in ours) < 1e-4


def test_rounding_noise_is_no_feature(spark):
    rows = tick_like(constant_spread=True)
    noisy = [(*r[:8], 1.5 + (i % 3) * 2e-16, r[9]) for i, r in enumerate(rows)]
    model = regression.fit(spark.createDataFrame(noisy, SCHEMA))
    assert model.coefficients[-1] == 0.0
    assert model.coefficients[:4] == pytest.approx(least_norm(rows)[0][:4].tolist(), rel=1e-5)


def test_constant_features_have_no_weight(spark):
    rows = [(i, "A", None, 1.0, 1.0, 1.0, float(i), 1.0, 0.0, 2.0 * i + 3) for i in range(20)]
    model = regression.fit(spark.createDataFrame(rows, SCHEMA))
    assert model.coefficients == pytest.approx([0, 0, 0, 2, 0, 0])
    assert model.intercept == pytest.approx(3)


def test_fit_without_rows_is_an_error(spark):
    with pytest.raises(ValueError, match="no rows"):
        regression.fit(spark.createDataFrame([], SCHEMA))


def test_infinite_values_are_an_error(spark):
    rows = tick_like(20)
    rows[3] = (*rows[3][:7], float("inf"), *rows[3][8:])
    with pytest.raises(ValueError, match="infinite"):
        regression.fit(spark.createDataFrame(rows, SCHEMA))


def test_metrics_by_hand(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (5.0, 2.0)], f"{TARGET} double, prediction double")
    row = regression.metrics(frame).first()
    assert (row["mae"], row["n_test"]) == (2.0, 2) and row["rmse"] == pytest.approx(5**0.5)


def test_single_feature_equals_polyfit(spark):
    rows = tick_like()
    line = regression.single_feature(spark.createDataFrame(rows, SCHEMA)).first()
    slope, intercept = np.polyfit([r[6] for r in rows], [r[-1] for r in rows], 1)
    assert line["slope"] == pytest.approx(slope) and line["intercept"] == pytest.approx(intercept)


def test_train_measures_the_tail(spark):
    rows = tick_like(103)
    model, measured = regression.train(spark.createDataFrame(rows, SCHEMA), "tie")
    weights, intercept, _ = least_norm(rows[:82])
    tail = np.array([r[3:] for r in rows[82:]])
    miss = tail[:, -1] - (tail[:, :-1] @ weights + intercept)
    assert (measured["n_train"], measured["n_test"]) == (82, 21)
    assert measured["mae"] == pytest.approx(np.abs(miss).mean(), abs=1e-6)
    assert measured["rmse"] == pytest.approx(np.sqrt((miss**2).mean()), abs=1e-6)


def test_model_round_trip_and_missing_model(spark, path):
    model = regression.fit(spark.createDataFrame(tick_like(), SCHEMA))
    measured = {"mae": 0.1, "rmse": 0.2, "n_train": 8, "n_test": 2}
    regression.save(spark, model, measured, path("model"))
    regression.save(spark, model, measured, path("model"))
    assert regression.load(spark, path("model")) == (model, measured)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        regression.load(spark, path("nothing"))


def test_scoring_needs_no_python_worker(spark):
    frame = spark.createDataFrame(tick_like(20), SCHEMA)
    scored = regression.predict(regression.fit(frame), frame).where(F.col("prediction") > 0)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_a_model_without_a_named_target_predicts_the_former_column(spark, path):
    old = regression.LinearModel(["close"], [1.0], 0.0, None)
    regression.save(spark, old, {}, path("model"))
    assert regression.load(spark, path("model"))[0].target == "pred_close"
