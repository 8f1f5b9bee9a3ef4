"""The training-data pipeline: language ID, exact and near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and is written as Parquet and read again before the
next. All but the last return the columns of documents; a table without rows passes through.
"""

from pyspark.sql import DataFrame, SparkSession

from tickwright.llm import exact_dedup, language_id, mixing, packing, simhash
from tickwright.llm.common import table, written

#: Passes over a source's documents at most; no source comes less than once.
REPEATS = 1.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that no language model recognises, those without a letter among them."""
    return language_id.recognised(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the one with the largest doc_id."""
    return exact_dedup.last_of_each(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints keep the document with the smallest doc_id."""
    return simhash.first_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents of small sources up to the limit, in mixed order; drop none."""
    return mixing.mixed(docs, repeats=REPEATS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack every document, each as often as it comes."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("temperature_mixing", mixture),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


#: SQL has neither the tokenizer nor the models; the tests run the stages by brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
