"""Every registered query against its SQL on the smallest tables."""

import math
import pathlib

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
# the training-data queries have tests of their own in tests/llm
APART = {*contract.LLM_QUERIES, *contract.PIPELINE_QUERIES}
QUERIES = {k: v for k, v in contract.queries().items() if k not in APART}
ORACLES = {k: v for k, v in contract.oracle_sql().items() if k not in APART}

pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in pathlib.Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value + 0.0)
        return repr(value)

    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(found.columns) == sorted(columns)
    got = comparable([tuple(r) for r in found.collect()], found.columns)
    assert got == comparable(expected.fetchall(), columns)


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
