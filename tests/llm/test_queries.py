"""Registered queries that SQL can express, against their SQL on the smallest tables."""

import os

import pytest

from checks.compare import database, difference
from zonalis.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the generated tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    want = database(FOLDER).execute(ORACLES[name]).df()
    assert difference(QUERIES[name](spark, FOLDER).toPandas(), want) is None
