"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from millrace.plans.catalog import ORACLES, QUERIES
from tests.compare import connect, differences

SQL = ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    if name in SQL:
        assert differences(df, SQL[name], duck) == []
    else:
        assert df.count() > 0


def test_sql_twins_belong_to_queries():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    assert entry(spark).columns == ["region", "revenue", "orders"]
