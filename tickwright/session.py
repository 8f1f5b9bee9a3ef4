"""Session settings and the shared scratch area."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tickwright.sources import files

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_local_roots: dict[str, str] = {}


def build_session(app_name: str = "tickwright", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings our results depend on to a session somebody else made."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tickwright-")
    return _local_roots[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/tickwright/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all scratch tables of this application; no frame that reads them may be in use."""
    files.drop_folder(spark, _own_folder(spark))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Cuts the lineage before several passes over the same frame; unlike a cache it
    outlives lost executors, and later passes read only the columns they need.
    """
    path = scratch(df.sparkSession, name)
    return _write_and_read(df, path)


@contextmanager
def stored(df: DataFrame, name: str):
    """``written`` for as long as the block runs; the files go with it."""
    path = scratch(df.sparkSession, name)
    try:
        yield _write_and_read(df, path)
    finally:
        files.drop_folder(df.sparkSession, path)


def _write_and_read(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
