"""Table readers that cope with missing, empty and damaged files."""

import logging
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwright import settings
from tickwright.functions.predictions import LEGACY_PREDICTION, PREDICTION
from tickwright.schemas import ARRIVAL, PREDICTIONS, SILVER, STATS
from tickwright.sources import batches, files

log = logging.getLogger(__name__)

# Fixed value: what a Parquet file begins and ends with.
PARQUET_MAGIC = b"PAR1"

SNAPSHOT_PREFIX = "version="


def empty(spark: SparkSession, schema: T.StructType, row_id: str | None = None) -> DataFrame:
    fields = [T.StructField(row_id, T.LongType())] if row_id else []
    return spark.createDataFrame([], T.StructType(schema.fields + fields))


def _with_row_id(table: DataFrame, row_id: str | None) -> DataFrame:
    """``table`` has the column of arrival, which becomes the row id; rows without one get their place's hash."""
    if row_id is None:
        return table.drop(ARRIVAL)
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    others = [c for c in table.columns if c != ARRIVAL]
    return table.select(*others, F.coalesce(ARRIVAL, place).alias(row_id))


def _arriving(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(ARRIVAL, T.LongType())])


def read_tolerant(
    spark: SparkSession, path: str, schema: T.StructType, row_id: str | None = None
) -> DataFrame:
    """All Parquet rows below ``path``; zero-byte and damaged files are left out.

    The names of damaged ones are logged (``damaged_files`` gives them). All other files are read
    strictly: one that cannot be read to its end is an error, not a shorter table. A
    missing path is an empty table; of a table of batches the ones that count are read.
    ``row_id`` names an extra integer column that tells rows apart, is the same at every
    read and breaks ties between ticks of the same instant: where a tick came from in its topic
    or batch, so that the order of arrival outlives any rewriting of files. Rows that were stored
    without that get a number from their file and their place in it.
    """
    if not files.exists(spark, path):
        return empty(spark, schema, row_id)
    found = batches.live(spark, path).folders if batches.logged(spark, path) else [path]
    if not found:
        return empty(spark, schema, row_id)
    table = _sound_rows(spark, found, _arriving(schema))
    return _with_row_id(table, row_id)


def _sound_rows(spark: SparkSession, folders: list[str], schema: T.StructType) -> DataFrame:
    """The rows of all Parquet files below the folders but those that are damaged."""
    table = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(*folders)
    )
    damaged = _damaged(spark, folders)
    if damaged:
        log.warning("left out as no Parquet files: %s", [unquote(p) for p in damaged])
        # files are chosen by this before any of them is opened
        table = table.where(~F.col("_metadata.file_path").isin(damaged))
    return table


def damaged_files(spark: SparkSession, folders: list[str]) -> list[str]:
    """Files below the folders that are called Parquet and lack its marks.

    Spark passes over files of no bytes by itself, and unnamed. It lists the files, and tasks read what is needed of them: the footers in a scan without
    columns, and the first and last bytes of the few files that it shows no rows of. The driver
    gets the damaged ones' names. A file that cannot be opened is an error.
    """
    return sorted(unquote(p) for p in _damaged(spark, folders))


def _damaged(spark: SparkSession, folders: list[str]) -> list[str]:
    """The damaged files as Spark names them."""
    footers = (
        spark.read.schema("none string")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", True)
        .parquet(*folders)
    )
    whole = footers.select(F.col("_metadata.file_path").alias("path")).distinct()
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(folders)
    )
    named = listed.select(F.col("_metadata.file_path").alias("path"), "length")
    silent = named.join(whole, "path", "left_anti").collect()
    damaged = [r["path"] for r in silent if r["length"] < 12]
    rest = [r["path"] for r in silent if r["length"] >= 12]
    marks = PARQUET_MAGIC, PARQUET_MAGIC
    damaged += [p for p in rest if files.ends(spark, unquote(p), len(PARQUET_MAGIC)) != marks]
    return sorted(damaged)


def read_silver(spark: SparkSession, path: str, row_id: str | None = None) -> DataFrame:
    return read_tolerant(spark, path, SILVER, row_id)


def snapshot_versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a snapshot table, oldest first."""
    found = []
    for name, _ in files.children(spark, path):
        if name.startswith(SNAPSHOT_PREFIX) and files.exists(spark, f"{path}/{name}/_SUCCESS"):
            found.append(int(name[len(SNAPSHOT_PREFIX) :]))
    return sorted(found)


def read_stats(spark: SparkSession, path: str, n_files: int | None = None) -> DataFrame:
    """The newest complete snapshot, else all part files of an older table, else no rows.

    ``n_files`` takes only the newest part files, by the time they were last changed.
    """
    versions = snapshot_versions(spark, path)
    if versions:
        return spark.read.schema(STATS).parquet(f"{path}/{SNAPSHOT_PREFIX}{versions[-1]:010d}")
    if n_files is None:
        return read_tolerant(spark, path, STATS)
    if not files.exists(spark, path):
        return empty(spark, STATS)
    table = _sound_rows(spark, [path], STATS)
    place = F.struct("_metadata.file_modification_time", "_metadata.file_path").alias("place")
    newest = table.select(place).distinct().orderBy(F.desc("place")).limit(n_files).collect()
    return table.where(F.col("_metadata.file_path").isin([r["place"]["file_path"] for r in newest]))


def latest_changes(changes: DataFrame) -> DataFrame:
    """The last state of every window, with the batch that gave it.

    The pick is a hash aggregate that is reduced before the shuffle.
    """
    keys = ["window_start", "window_end", "symbol"]
    values = [c for c in STATS.fieldNames() if c not in keys]
    last = [F.max_by(c, "batch_id").alias(c) for c in values]
    return changes.groupBy(*keys).agg(*last, F.max("batch_id").alias("batch_id"))


def read_stats_changes(spark: SparkSession, path: str) -> DataFrame:
    """Latest statistics of every window from a table of changes.

    Each batch added the windows it changed, a window once; the highest batch id wins. Only
    folded segments and the batches after them are opened.
    """
    tagged = T.StructType([*STATS.fields, T.StructField("batch_id", T.LongType())])
    folders = batches.live(spark, path).folders
    if not folders:
        return empty(spark, STATS)
    changes = spark.read.schema(tagged).parquet(*folders)
    return latest_changes(changes).select(*STATS.fieldNames())


def read_predictions(
    spark: SparkSession,
    path: str,
    n_batches: int | None = settings.LATEST_BATCHES,
    row_id: str | None = None,
) -> DataFrame:
    """Stored predictions of the newest ``n_batches`` batches (None: of all).

    Older batches are not read, nor are batches that are still being written. Old files have
    the prediction under its former name only; both names are asked for, so that no footers
    have to be merged.
    """
    found = batches.live(spark, path, n_batches)
    if not found.folders:
        return empty(spark, PREDICTIONS, row_id)
    tagged = [
        T.StructField("batch_id", T.LongType()) if f.name == "batch_id" else f
        for f in [*PREDICTIONS.fields, T.StructField(LEGACY_PREDICTION, T.DoubleType())]
    ]
    table = _sound_rows(spark, found.folders, _arriving(T.StructType(tagged)))
    if found.since is not None:
        table = table.where(F.col("batch_id") >= found.since)
    table = _with_row_id(table, row_id)
    table = table.withColumn(PREDICTION, F.coalesce(PREDICTION, LEGACY_PREDICTION))
    wanted = [F.col(f.name).cast(f.dataType).alias(f.name) for f in PREDICTIONS]
    return table.select(*wanted, *([row_id] if row_id else []))
