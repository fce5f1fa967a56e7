from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql
from registry.oracles import ORACLES
from registry.queries import QUERIES

from .compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).columns == [
        "l_orderkey",
        "l_linenumber",
        "CIVIC",
        "STREET",
        "TYPE",
        "complement",
    ]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_gives_what_its_sql_gives(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name) is None
