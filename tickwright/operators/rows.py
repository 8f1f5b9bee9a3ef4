"""Questions about the number of rows, and numbers for them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEW = 1000


def has_rows(df: DataFrame, n: int) -> bool:
    """Whether there are at least ``n`` rows.

    For a few rows it reads partition after partition until it has them; otherwise it
    counts, which takes no more than the footers of a stored table.
    """
    if n <= FEW:
        return len(df.select(F.lit(1)).head(n)) >= n
    return df.count() >= n


#: A number's last bits count the rows of a batch, those before them the batches.
_ROW_BITS = 36
_TASK_BITS = 33  # of the numbers that Spark gives within a task


def numbered(df: DataFrame, name: str, batch_id: int) -> DataFrame:
    """Add an integer that rises over the rows of a batch as they were read, and over batches.

    Rows are counted per partition, so none of them moves; ``df`` should be persisted, as it is
    read twice. Lines of a file keep their order within each of the parts it is read in.
    """
    if batch_id >> (62 - _ROW_BITS):
        raise ValueError(f"batch {batch_id} cannot be numbered")
    part = F.spark_partition_id()
    counts = df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, offsets = batch_id << _ROW_BITS, {}
    for r in sorted(counts):
        offsets[r["part"]] = before
        before += r["n"]
    if before - (batch_id << _ROW_BITS) >> _ROW_BITS:
        raise ValueError(f"a batch of {before} rows cannot be numbered")
    if not offsets:
        return df.withColumn(name, F.lit(None).cast("long"))
    parts, firsts = (F.array(*map(F.lit, own)).cast("array<long>") for own in zip(*offsets.items()))
    first = F.element_at(F.map_from_arrays(parts, firsts), part.cast("long"))
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _TASK_BITS) - 1))
    return df.withColumn(name, first + within)
