"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry_point
import compare
from txrisk.plans.catalog import QUERIES
from txrisk.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def sql(tiny):
    with compare.connect(tiny) as con:
        yield con


def test_oracle_names_are_queries():
    assert set(ORACLE) == set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sql, tiny, name):
    assert compare.differences(QUERIES[name](spark, tiny), sql, ORACLE[name]) == []


def test_entry(spark):
    assert entry_point.entry(spark).columns[:3] == ["model", "weight_pos", "weight_neg"]
