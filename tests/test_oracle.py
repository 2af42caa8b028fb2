"""Every query with an SQL twin gives the twin's rows; no plan holds a cross join."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import difference, duck

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(SQL))
def test_matches_sql(spark, con, sf_dir, name):
    assert difference(spark, con, sf_dir, queries()[name], SQL[name]).startswith("ok")


def test_oracle_names_are_queries():
    assert set(SQL) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 1500


@pytest.mark.parametrize("name", ["curated_features", "kfold_contiguous", "gnb_scores", "corr_spearman", "lineage_log"])
def test_no_cross_join(spark, sf_dir, name):
    plan = queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
