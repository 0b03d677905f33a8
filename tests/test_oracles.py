"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from rollcall.catalogue.registry import QUERIES as REGISTERED
from tests.compare import check, connect

SF_DIR = "/root/testdata/sf0.001"
# trained models have no SQL and are covered by test_model.py
TRAINED = {"ml_05_random_forest", "ml_06_boosted_trees", "ml_09_feature_importance"}
# the text operators have their own tests
QUERIES = {name: run for name, run in entry.queries().items() if name in REGISTERED}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in REGISTERED}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_only_trained_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == TRAINED


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    state, text = check(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR)
    assert state == "ok", text
