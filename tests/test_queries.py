"""Every registered query against its SQL, over whole tables."""

import pytest

from corpus_mt.plans.all import ORACLES, QUERIES
from tests.oracle import connect, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    names, rows = spark_rows(QUERIES[name](spark, FOLDER))
    want_names, want = sql_rows(con, ORACLES[name])
    assert names == want_names
    assert len(rows) == len(want)
    assert rows == want
