"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k not in entry.LLM_QUERIES}
SKETCHED = {
    "entity_metrics_approx",
    "user_metrics_approx",
    "global_metrics_approx",
    "column_profile_lineitem",
}


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, db, name):
    found = entry.queries()[name](spark, SF_DIR)
    assert differences(found, db, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(SKETCHED))
def test_sketched_query_has_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_only_sketched_queries_lack_an_oracle():
    assert set(entry.queries()) - set(entry.LLM_QUERIES) - set(ORACLES) == SKETCHED


def test_entry(spark):
    assert 0 < entry.entry(spark).count() <= 100
