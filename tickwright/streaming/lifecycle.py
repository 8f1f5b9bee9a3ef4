"""State settings, checkpoints and the end of streams."""

import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tickwright.sources import batches, files

# Class names of the two state stores that come with Spark.
STATE_STORES = {
    "hdfs": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
#: A stream takes over the session's settings when it starts; two of them must not mix theirs.
_starting = threading.Lock()

ON_START = ("resume", "replay_if_empty", "fresh")


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None, store: str = "hdfs"):
    """Settings a stateful stream takes with it when it starts.

    The checkpoint pins the number of state partitions for good, so it follows the
    cluster's parallelism and not the session's setting for batch shuffles. Streams that are
    started by several threads take turns.
    """
    wanted = {
        "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism),
        "spark.sql.streaming.stateStore.providerClass": STATE_STORES[store],
    }
    with _starting:
        before = {key: spark.conf.get(key) for key in wanted}
        for key, value in wanted.items():
            spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                spark.conf.set(key, value)


def checkpoint_path(
    spark: SparkSession, root: str, on_start: str = "resume", output: str | None = None
) -> str:
    """The checkpoint a stream should start on; runs are numbered below ``root``.

    ``resume`` goes on with the last run, ``fresh`` opens a new one, ``replay_if_empty``
    opens a new one when no batch is stored in ``output``. Old runs are left alone.
    """
    if on_start not in ON_START:
        raise ValueError(f"unknown start option: {on_start}")
    runs = [int(name[4:]) for name, _ in files.children(spark, root) if name.startswith("run=")]
    last = max(runs, default=0)
    renew = on_start == "fresh"
    if on_start == "replay_if_empty":
        renew = not batches.entries(spark, output, newest=1)
    if renew and runs:
        last += 1
    return f"{root}/run={last:06d}"


def await_all(spark: SparkSession, queries: list) -> None:
    """Wait until any stream ends, then stop the others too."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()
