"""Times the headline queries and streams; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickwright.operators import regression  # noqa: E402
from tickwright.plans import batch, streams  # noqa: E402
from tickwright.plans.bridge import labelled, plain_ticks  # noqa: E402
from tickwright.session import build_session, clear_scratch, scratch  # noqa: E402
from tickwright.sources.ticks import tick_stream  # noqa: E402
from tickwright.streaming import jobs  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")

BATCH = [
    "window_stats_tumbling",
    "window_stats_sliding",
    "tick_parse_json",
    "silver_features",
    "next_close_label",
    "next_close_label_sliced",
    "training_set",
    "chrono_split",
    "linreg_train",
    "regression_metrics",
    "online_error",
    "error_histogram",
    "latest_batches",
    "latest_predictions",
    "daily_payload_flatten",
]


def timed(run) -> float:
    started = time.perf_counter()
    run()
    return round(time.perf_counter() - started, 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def stream_rate(query) -> float:
    """Rows per second over the batches that had rows, by the stream's own clock."""
    streams.finish(query)
    worked = [p for p in query.recentProgress if p["numInputRows"]]
    rows = sum(p["numInputRows"] for p in worked)
    millis = sum(p["durationMs"]["triggerExecution"] for p in worked)
    return round(rows / millis * 1000, 1)


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in BATCH:
        query = batch.prepared(batch.QUERIES[name])
        # the first run compiles the plan's code, the second is measured
        drain(query(spark, SF_DIR))
        seconds[name] = timed(lambda query=query: drain(query(spark, SF_DIR)))

    ticks = tick_stream(spark, "json", streams.published(spark, SF_DIR))
    model = regression.fit(labelled(spark, SF_DIR))
    now = {"trigger": jobs.AVAILABLE_NOW}

    def places():
        return scratch(spark, "output"), scratch(spark, "checkpoint")

    starts = {
        "stream_silver": lambda: jobs.start_silver(ticks, *places(), **now),
        "stream_stats_update": lambda: jobs.start_stats_changes(ticks, *places(), **now),
        "stream_stats_complete": lambda: jobs.start_stats_snapshot(ticks, *places(), **now),
        "stream_score": lambda: jobs.start_scoring(ticks, model, *places(), **now),
    }
    rates = {}
    for name, start in starts.items():
        stream_rate(start())

        def measured(name=name, start=start):
            rates[name] = stream_rate(start())

        seconds[name] = timed(measured)

    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries and streams",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "stream_rows_per_sec": rates,
                "ticks": plain_ticks(spark, SF_DIR).count(),
                "sf": os.path.basename(SF_DIR).removeprefix("sf"),
            }
        )
    )
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
