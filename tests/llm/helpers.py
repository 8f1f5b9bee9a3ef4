"""What several tests of the training-data operators need."""

import pathlib

import duckdb

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
LARGE = "/root/testdata/sf0.1"


def duck(sf_dir):
    connection = duckdb.connect()
    for file in pathlib.Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows(df, *columns):
    """A frame's rows as tuples, sorted with NULLs first."""
    df = df.select(*columns) if columns else df
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is not None, x) for x in r))
