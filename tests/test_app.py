import json
from datetime import datetime, timedelta

import pytest

from tickwright import app
from tickwright.settings import Settings
from tickwright.sources import files, tables
from tickwright.streaming import jobs

T0 = datetime(2024, 1, 1)


def messages(n):
    for i in range(n):
        close = 100.0 + (i * 7 % 11) / 10
        yield json.dumps(
            {
                "event_time": (T0 + timedelta(seconds=i)).isoformat() + "+00:00",
                "symbol": "IBM",
                "open": close - 0.1,
                "high": close + 0.3,
                "low": close - 0.4,
                "close": close,
                "volume": float(100 + i % 13),
                "source": "simulated",
            }
        )


def payload(days):
    series = {
        (T0 - timedelta(days=i)).strftime("%Y-%m-%d"): {
            "1. open": f"{100 + i % 5}",
            "2. high": f"{102 + i % 7}",
            "3. low": f"{99 - i % 3}",
            "4. close": f"{101 + i % 4}",
            "5. volume": f"{1000 + i}",
        }
        for i in range(1, days + 1)
    }
    return json.dumps({"Meta Data": {"2. Symbol": "IBM"}, "Time Series (Daily)": series})


def settings(path):
    return Settings(output_dir=path("output"), checkpoint_dir=path("output/checkpoints"))


def views(spark, config):
    return {name: view.collect() for name, view in app.report(spark, config).items()}


def test_stream_train_predict_report(spark, path):
    config = settings(path)
    files.write_text(spark, path("in/0.json"), "\n".join(messages(100)) + "\n")
    now = jobs.AVAILABLE_NOW

    blank = views(spark, config)
    assert tuple(blank["counts"][0]) == (0, 0) and blank["online_mae"][0]["mae"] == 0.0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        app.start_predictor(spark, config, path("in"), now)

    for query in app.start_processor(spark, config, path("in"), now):
        assert query.awaitTermination(120)
    measured = app.train_model(spark, config)
    assert (measured["n_train"], measured["n_test"]) == (79, 20)

    demo = views(spark, config)
    assert tuple(demo["counts"][0]) == (10, 99)

    assert app.start_predictor(spark, config, path("in"), now).awaitTermination(120)
    shown = views(spark, config)
    assert tuple(shown["counts"][0]) == (10, 99)
    assert shown["online_mae"][0]["mae"] > 0 and len(shown["predicted_and_actual"]) == 198
    assert sum(r["n"] for r in shown["error_histogram"]) == 99
    names = {r["name"]: r["input_rows"] for r in shown["progress"]}
    assert {"bronze_silver", "stats_changes", "predictions"} <= set(names)
    assert len(shown["avg_close"]) == 10

    # a second start resumes the tables; a snapshot is kept on demand
    for query in app.start_processor(spark, config, path("in"), now, complete=True):
        assert query.awaitTermination(120)
    assert tables.read_silver(spark, config.table("silver")).count() == 100
    assert tables.read_stats(spark, config.table("stats")).count() == 10


def test_training_falls_back_on_history(spark, path):
    config = settings(path)
    with pytest.raises(ValueError, match="0 labelled rows"):
        app.train_model(spark, config)
    files.write_text(spark, path("payloads/ibm.json"), payload(150))
    measured = app.train_model(spark, config, path("payloads"))
    assert measured["n_train"] + measured["n_test"] == 149


def test_settings_from_environment():
    assert Settings.from_env({}) == Settings()
    config = Settings.from_env({"STREAM_WINDOW_SECONDS": "60", "OUTPUT_DIR": "s3a://x/y"})
    assert (config.window, config.slide) == ("60 seconds", "10 seconds")
    assert config.table("silver") == "s3a://x/y/silver"


def test_cleaning_removes_what_does_not_count(spark, path):
    config = settings(path)
    assert app.clean(spark, config) == {}
    files.write_text(spark, path("in/0.json"), "\n".join(messages(20)) + "\n")
    streams = app.start_processor(spark, config, path("in"), jobs.AVAILABLE_NOW)
    try:
        for query in streams:
            query.awaitTermination()
    finally:
        spark.streams.resetTerminated()
    lost = f"{config.table('silver')}/data/lost-try"
    files.write_text(spark, f"{lost}/part-0.parquet", "cut off")
    assert app.clean(spark, config)["silver"] == []  # it may still be written
    gone = app.clean(spark, config, grace=-60)
    assert gone["silver"] == ["lost-try"] and not gone["bronze"] and not gone["stats_changes"]
    assert tables.read_silver(spark, config.table("silver")).count() == 20
    assert tables.read_stats_changes(spark, config.table("stats_changes")).count()
