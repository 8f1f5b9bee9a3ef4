"""Small helpers of the operators: missing columns, row keys, tables that cut lineage."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwright.session import scratch, written

__all__ = [
    "address",
    "documents",
    "fresh",
    "keep_addressed",
    "remainder",
    "scratch",
    "slices",
    "table",
    "written",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns, those that are lacking as NULL strings; others are left behind."""
    return docs.select(
        *[
            docs[f"`{c}`"].alias(c) if c in docs.columns else F.lit(None).cast("string").alias(c)
            for c in columns
        ]
    )


def remainder(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; a NULL key has remainder 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % n, F.lit(0))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its own are called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def address(doc_id: Column | str, sha: Column | str) -> Column:
    """Where a document is: its text's digest and its id. Rows with both equal are repeats."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.concat_ws(":", sha, F.coalesce(doc_id.cast("string"), F.lit("null")))


def text_sha(text: Column | str) -> Column:
    """SHA-256 of a text in UTF-8; NULL counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def keep_addressed(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows of ``docs`` at the addresses ``marks.address``, of repeated rows one each.

    ``marks`` holds no address twice. Of rows with equal id and text, that with the smallest other
    columns, written as JSON, stays. Repeats are reduced before the only shuffle of the texts, whose
    partitioning the join uses, so that no task gets all repeats of one row.
    """
    at, kept = fresh(docs, "address"), fresh(docs, "kept")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "doc_id")]
    order = F.to_json(F.struct(*others)) if others else F.lit(0)
    rows = docs.groupBy(address("doc_id", text_sha("text")).alias(at))
    one = rows.agg(F.min_by(F.struct(*columns), order).alias(kept))
    stay = one.join(marks.select(F.col("address").alias(at)), at, "left_semi")
    return stay.select(*[F.col(kept)[c].alias(c) for c in docs.columns])


def slices(frame: pd.DataFrame, rows: int = 10_000) -> Iterator[pd.DataFrame]:
    """A frame in parts of so many rows; an empty one as it is."""
    for at in range(0, max(1, len(frame)), rows):
        yield frame.iloc[at : at + rows]
