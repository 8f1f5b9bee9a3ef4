"""The registered queries and stages as the contract names them."""

import re

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.helpers import SMALL, duck
from tickwright.llm import queries


def test_each_number_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    found = contract.queries()[name](spark, SMALL)
    expected = duck(SMALL).execute(contract.oracle_sql()[name])
    assert found.columns == [c[0] for c in expected.description]
    assert sorted(map(tuple, found.collect())) == sorted(expected.fetchall())


def test_stages_are_the_named_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id",
        "exact_dedup",
        "simhash_near_dedup",
        "temperature_mixing",
        "best_fit_packing",
    ]
