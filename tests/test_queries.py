"""Every registered query against its SQL counterpart on the smallest test set."""

import re

import pytest

from lakeloom.queries import ORACLE, QUERIES
from tests.helpers import plan
from tests.oracle import DATA, check, connect

FOLDER = DATA.format("0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def stays_in_the_engine(df):
    """No Python per row, no product of rows."""
    text = plan(df)
    assert not re.search("BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    ok, message = check(spark, con, key, FOLDER, stays_in_the_engine)
    spark.catalog.clearCache()
    assert ok, message


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
