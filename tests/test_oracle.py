"""Every query against its SQL, on the whole test tables."""

import os

import pytest
from compare import compare, duck

from __spark_entry__ import entry, oracle_sql, queries
from stationflow.checks.oracle import all_sql
from stationflow.checks.queries import all_queries

SF_DIR = os.getenv("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, connection, name):
    assert compare(spark, name, queries()[name], oracle_sql()[name], SF_DIR, connection) is None


def test_only_model_queries_lack_sql():
    assert set(all_queries()) - set(all_sql()) == {"gbt_metrics", "batch_predict"}
    assert set(all_sql()) <= set(all_queries()) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_the_ml_layout(spark):
    from stationflow.schemas import ML_COLUMNS

    frame = entry(spark)
    assert frame.columns == ML_COLUMNS and len(frame.columns) == 51
    assert frame.count() > 0
