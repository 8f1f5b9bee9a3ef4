"""Parquet writers that survive a repeated batch and show readers complete tables only."""

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickwright import settings
from tickwright.operators.rows import has_rows
from tickwright.schemas import HISTORY
from tickwright.sources import files
from tickwright.sources.tables import SNAPSHOT_PREFIX, read_tolerant, snapshot_versions

#: Readers that began before a snapshot was replaced have so many seconds to end.
GRACE = 600.0


def write_snapshot(df: DataFrame, path: str, order: list[str], grace: float = GRACE) -> bool:
    """Replace the table by ``df`` in the given order; an empty ``df`` changes nothing.

    The rows go to a new version folder, which readers take once its success marker is
    there. A version goes ``grace`` seconds after a newer one was complete, so that readers that are
    still busy with it can end, however fast versions follow each other.
    """
    spark = df.sparkSession
    df = df.persist()
    try:
        if df.isEmpty():
            return False
        taken = [
            int(name[len(SNAPSHOT_PREFIX) :])
            for name, _ in files.children(spark, path)
            if name.startswith(SNAPSHOT_PREFIX)
        ]
        version = max(taken, default=-1) + 1
        df.orderBy(*order).write.parquet(f"{path}/{SNAPSHOT_PREFIX}{version:010d}")
    finally:
        df.unpersist()
    until = (time.time() - grace) * 1000
    versions = snapshot_versions(spark, path)
    for old, newer in zip(versions, versions[1:]):
        done = f"{path}/{SNAPSHOT_PREFIX}{newer:010d}/_SUCCESS"
        if files.modified(spark, done) > until:
            break
        files.drop_folder(spark, f"{path}/{SNAPSHOT_PREFIX}{old:010d}")
    return True


def clear_snapshot(spark: SparkSession, path: str) -> None:
    """Forget all versions and loose part files, as at a fresh start."""
    for name, _ in files.children(spark, path):
        files.drop_folder(spark, f"{path}/{name}")


def cached_history(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    min_rows: int = settings.MIN_HISTORY_ROWS,
) -> DataFrame:
    """The history table at ``path`` if it has ``min_rows`` rows, else built and stored anew."""
    cached = read_tolerant(spark, path, HISTORY)
    if has_rows(cached, min_rows):
        return cached
    build().select(*HISTORY.fieldNames()).write.mode("overwrite").parquet(path)
    return read_tolerant(spark, path, HISTORY)
