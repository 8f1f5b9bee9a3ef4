import random
from datetime import datetime, timedelta

import pytest

from tickwright.operators.windows import window_stats
from tickwright.schemas import STATS, TICK

T0 = datetime(2024, 1, 1)


def tick(second, close, symbol="A", volume=1.0):
    at = None if second is None else T0 + timedelta(seconds=second)
    return (at, symbol, 1.0, 1.0, 1.0, close, volume, "s")


def stats(spark, rows, *span):
    found = window_stats(spark.createDataFrame(rows, TICK), *span)
    assert found.columns == STATS.fieldNames()
    return {(r["symbol"], (r["window_start"] - T0).total_seconds()): r for r in found.collect()}


def test_values_and_bounds(spark):
    found = stats(spark, [tick(1, 1.0), tick(9.9, 3.0, volume=3.0), tick(10, 7.0)])
    first, second = found["A", 0], found["A", 10]
    assert (first["min_close"], first["max_close"], first["avg_close"]) == (1.0, 3.0, 2.0)
    assert (first["var_close"], first["avg_volume"], first["n_obs"]) == (2.0, 2.0, 2)
    assert first["window_end"] == T0 + timedelta(seconds=10)
    assert second["n_obs"] == 1 and second["var_close"] is None


def test_null_close_counts_but_adds_nothing(spark):
    row = stats(spark, [tick(1, None), tick(2, 4.0)])["A", 0]
    assert (row["n_obs"], row["avg_close"], row["var_close"]) == (2, 4.0, None)


def test_null_time_is_in_no_window_and_null_symbol_in_its_own(spark):
    found = stats(spark, [tick(None, 1.0), tick(1, 2.0, None), tick(2, 3.0)])
    assert set(found) == {(None, 0), ("A", 0)}


def test_sliding_windows_overlap(spark):
    found = stats(spark, [tick(12, 5.0)], "10 seconds", "5 seconds")
    assert set(found) == {("A", 5), ("A", 10)}


def plain_windows(rows, size, slide):
    """Statistics of every window by its definition, from closes and volumes."""
    found = {}
    for at, symbol, *_, close, volume, _ in rows:
        if at is None:
            continue
        # windows begin at multiples of the slide since the epoch
        epoch = (T0 - datetime(1970, 1, 1)).total_seconds()
        second = (at - datetime(1970, 1, 1)).total_seconds()
        start = second // slide * slide
        while start > second - size:
            found.setdefault((symbol, start - epoch), []).append((close, volume))
            start -= slide
    out = {}
    for key, own in found.items():
        closes = [c for c, _ in own if c is not None]
        volumes = [v for _, v in own if v is not None]
        mean = sum(closes) / len(closes) if closes else None
        var = sum((c - mean) ** 2 for c in closes) / (len(closes) - 1) if len(closes) > 1 else None
        average = sum(volumes) / len(volumes) if volumes else None
        out[key] = (min(closes, default=None), max(closes, default=None), mean, var, average, len(own))
    return out


@pytest.mark.parametrize("size, slide", [(10, 5), (60, 7), (30, 20), (10, 10)])
def test_sliding_windows_are_those_of_the_definition(spark, size, slide):
    """Large closes that differ little, gaps, NULLs, a hot symbol; sizes that the slide does not divide."""
    rng = random.Random(5)
    rows = [
        tick(
            rng.choice([None, rng.randrange(-90, 400) + rng.random()]),
            rng.choice([None, 1e6 + rng.random() / 100]),
            rng.choice(["HOT", "HOT", "B", None]),
            rng.choice([None, 2.0, 7.5]),
        )
        for _ in range(400)
    ]
    found = stats(spark, rows, f"{size} seconds", f"{slide} seconds")
    expected = plain_windows(rows, size, slide)
    assert set(found) == set(expected)
    for key, values in expected.items():
        row = found[key]
        got = [row[c] for c in ("min_close", "max_close", "avg_close", "var_close", "avg_volume", "n_obs")]
        assert got == [v if v is None else pytest.approx(v, rel=1e-6, abs=1e-12) for v in values]
        assert row["window_end"] - row["window_start"] == timedelta(seconds=size)


def test_ticks_are_reduced_to_panes_before_they_are_copied(spark):
    plan = window_stats(spark.createDataFrame([tick(1, 1.0)], TICK), "1 hour", "10 seconds")._jdf
    text = plan.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    # a plan is written from its result down to its source
    copied, reduced = text.index("Generate explode"), text.index("partial_var_pop")
    assert copied < text.rindex("Exchange hashpartitioning") < reduced and "Expand" not in text


def test_partial_aggregation_precedes_the_only_shuffle(spark):
    plan = window_stats(spark.createDataFrame([tick(1, 1.0)], TICK))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "partial_min" in text
