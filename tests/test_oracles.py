"""Every registered query against its oracle."""

import os

import pytest
from compare import database, difference
from conftest import TESTDATA

from metascope.suite import ORACLES, QUERIES

SF_DIR = f"{TESTDATA}/sf{os.environ.get('ORACLE_SF', '0.001')}"


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None
