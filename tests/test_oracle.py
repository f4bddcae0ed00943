"""Each query against its SQL twin on the given tables."""

import os

import pytest

from verification import oracle, queries
from verification.compare import connect, differences

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
RUNNABLE, STATEMENTS = queries.runnable(), oracle.statements()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_twin_belongs_to_a_query():
    assert set(STATEMENTS) == set(RUNNABLE)


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_same_as_sql(spark, con, name):
    assert differences(spark, RUNNABLE[name], STATEMENTS[name], SF_DIR, con) == []


@pytest.mark.parametrize("name", ["train_score", "seq_trailing6", "roc_points", "day_features", "hist_combined"])
def test_has_rows_to_compare(spark, name):
    assert len(RUNNABLE[name](spark, SF_DIR).take(20)) == 20
