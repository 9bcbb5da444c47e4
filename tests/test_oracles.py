"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest

from checks.catalog import QUERIES
from checks.compare import check, connect, difference
from checks.oracles import ORACLES
from tests.conftest import SF_CHECK, SF_SMALL, plan


@pytest.fixture(scope="module")
def small_db():
    return connect(SF_SMALL)


@pytest.fixture(scope="module")
def check_db():
    return connect(SF_CHECK)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


# No Python in the row path, no pairing of everything with everything.
FORBIDDEN = ("EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, small_db, name):
    df = QUERIES[name](spark, SF_SMALL)
    problem = difference(df.toPandas(), small_db.sql(ORACLES[name]).df())
    assert problem is None, problem
    assert not [operator for operator in FORBIDDEN if operator in plan(df)]


@pytest.mark.parametrize(
    "name, expected",
    {
        "clean_satellite": 7_017,
        "hourly_satellite_stats": 701,
        "hourly_coverage_stats": 3_050,
        "hourly_performance_stats": 3_062,
        "join_coverage_performance": 10_000,
        "dashboard_view": 3_050,
        "region_coverage_from_positions": 3_600,
        "recent_coverage_all": 500,
    }.items(),
)
def test_acceptance_counts(spark, check_db, name, expected):
    problem, rows = check(spark, check_db, name, SF_CHECK)
    assert problem is None, problem
    assert rows == expected


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    # the training-data queries, which may be absent, list their own exceptions
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
