"""Every registered query against its DuckDB SQL on the smallest scale."""

import os

import pytest

import __spark_entry__ as spark_entry
from tests.check_oracles import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = spark_entry.queries(), spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables here")
    return connect(SF_DIR)


def test_every_query_of_the_lakehouse_has_an_oracle():
    corpus = set(spark_entry.corpus_queries.queries()) if spark_entry.corpus_queries else set()
    assert set(QUERIES) - corpus == set(ORACLES) - corpus


@pytest.mark.parametrize("name", [n for n in ORACLES if not n.startswith("op") and n != "pipeline"])
def test_query_matches_oracle(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name, QUERIES[name], ORACLES[name]) is None
