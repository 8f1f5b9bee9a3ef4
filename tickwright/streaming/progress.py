"""Stream progress as files."""

import json
import threading
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from tickwright.sinks.batches import fold, write_batch
from tickwright.sources import batches, files
from tickwright.sources.logs import ROLLED, loose_progress

#: Documents are rolled up once there are so many new ones.
ROLL = 1000
#: So many rolled-up tables are folded into one.
FAN = 8


def roll_up(spark: SparkSession, path: str, fan: int = FAN) -> int:
    """Put the documents that are files of their own into a table; returns how many there were.

    Their files go when the next ones are rolled up, so that readers which have listed them can end. If
    this breaks off, some documents are in the table and still files: readers count them once.
    """
    table = f"{path}/{ROLLED}"
    last = batches.entries(spark, table, newest=1)
    number = max(last, default=batches.last_folded(batches.segments(spark, table))) + 1
    for entry in last.values():
        stored = spark.read.parquet(batches.folder(table, entry.attempt))
        for row in stored.select("file").distinct().collect():
            files.drop_folder(spark, unquote(row["file"]))
    n = write_batch(loose_progress(spark, path).coalesce(1), table, number)
    fold(spark, table, fan=fan)
    return n


class ProgressFiles(StreamingQueryListener):
    """Writes each progress of each stream as a one-line JSON file.

    A stream's files lie in a folder of its name; a retried batch gives another file, and
    readers take the last progress by time. After every ``roll`` documents the files are rolled up into
    a table, beside the streams. No progress is lost by that, as totals need every one.
    """

    def __init__(self, spark: SparkSession, path: str, roll: int = ROLL):
        super().__init__()
        self.spark = spark
        self.path = path
        self.roll, self.seen = roll, 0
        self.rolling = threading.Lock()

    def _roll_up(self):
        # one at a time; documents that come meanwhile are for the next
        if self.rolling.acquire(blocking=False):
            try:
                roll_up(self.spark, self.path)
            finally:
                self.rolling.release()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        document = json.loads(event.progress.json)
        name = document.get("name") or "unnamed_query"
        stamp = document["timestamp"].replace(":", "-")
        target = f"{self.path}/{name}/{document['batchId']:010d}-{stamp}.json"
        files.write_text(self.spark, target, json.dumps(document) + "\n")
        self.seen += 1
        if self.seen % self.roll == 0:
            threading.Thread(target=self._roll_up, daemon=True).start()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def watch(spark: SparkSession, path: str) -> ProgressFiles:
    """Record the progress of the streams that start from now on."""
    drain(spark)
    listener = ProgressFiles(spark, path)
    spark.streams.addListener(listener)
    return listener


def drain(spark: SparkSession) -> None:
    """Wait until the listeners have seen every progress that was posted so far."""
    spark._jsc.sc().listenerBus().waitUntilEmpty()
