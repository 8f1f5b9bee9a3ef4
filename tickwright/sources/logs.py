"""Run logs and stream progress."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwright.functions.numbers import human_bytes
from tickwright.schemas import PROGRESS, RUN_LOG
from tickwright.sources import batches, files
from tickwright.sources.tables import empty

# Fixed value: how run logs write a time, with or without microseconds.
RUN_TIME = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """CSV run log with a header; a missing log has no runs, a bad field is NULL."""
    if not files.exists(spark, path):
        return empty(spark, RUN_LOG)
    reader = spark.read.schema(RUN_LOG).option("header", True)
    return reader.option("timestampNTZFormat", RUN_TIME).csv(path)


#: Below a folder of progress documents: a table of those that were rolled up.
ROLLED = "_rolled"


def loose_progress(spark: SparkSession, path: str) -> DataFrame:
    """Progress documents that are files of their own, one JSON object per line, and their files."""
    file = F.col("_metadata.file_path").alias("file")
    return (
        spark.read.schema(PROGRESS)
        .option("recursiveFileLookup", True)
        .json(path)
        .select("*", file)
        .where(F.col("batchId").isNotNull())
    )


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """All progress documents; broken lines are left out.

    Those that were rolled up come from few files. One that is still a file of its own, too, counts once.
    """
    if not files.exists(spark, path):
        return empty(spark, PROGRESS)
    loose = loose_progress(spark, path).drop("file")
    rolled = batches.live(spark, f"{path}/{ROLLED}").folders
    if not rolled:
        return loose
    stored = spark.read.schema(PROGRESS).parquet(*rolled)
    return loose.union(stored).dropDuplicates(["id", "runId", "name", "batchId", "timestamp"])


def latest_progress(progress: DataFrame) -> DataFrame:
    """The last progress of every query."""
    last = F.max_by(F.struct(*progress.columns), F.struct("timestamp", "batchId"))
    named = F.coalesce("name", F.lit("unnamed_query"))
    return progress.withColumn("name", named).groupBy("name").agg(last.alias("p")).select(
        F.col("name"), *[F.col(f"p.{c}").alias(c) for c in progress.columns if c != "name"]
    )


def progress_metrics(progress: DataFrame) -> DataFrame:
    """Rates, batch time and state figures of each progress; absent figures are 0."""
    state = F.get("stateOperators", 0)

    def figure(column, kind):
        return F.coalesce(column, F.lit(0)).cast(kind)

    memory = figure(state["memoryUsedBytes"], "long")
    return progress.select(
        "name",
        F.col("batchId").alias("batch_id"),
        figure(F.col("inputRowsPerSecond"), "double").alias("input_rate"),
        figure(F.col("processedRowsPerSecond"), "double").alias("processing_rate"),
        figure(F.col("durationMs.triggerExecution"), "long").alias("batch_ms"),
        memory.alias("state_bytes"),
        human_bytes(memory).alias("state_memory"),
        figure(F.col("numInputRows"), "long").alias("input_rows"),
        figure(state["numRowsTotal"], "long").alias("state_rows"),
        figure(state["numRowsUpdated"], "long").alias("updated_rows"),
        figure(state["numRowsDroppedByWatermark"], "long").alias("dropped_rows"),
    )
