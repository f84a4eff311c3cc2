from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import quality as q
from tests.conftest import rows

RULES = {"positive": "amount > 0", "known": "region IS NOT NULL"}


@pytest.fixture(scope="module")
def facts(spark):
    data = [(1, 10.0, "W"), (2, -1.0, "E"), (3, None, None), (3, 5.0, "S")]
    return spark.createDataFrame(data, "id int, amount double, region string")


def rules():
    return {n: F.expr(e) for n, e in RULES.items()}


def test_row_rules_count_null_as_violation(facts):
    assert rows(q.row_rules(facts, rules())) == [("known", 1, False), ("positive", 2, False)]


def test_single_checks(facts):
    parent = facts.filter("id < 3")
    suite = q.dq_suite(
        q.dq_unique(facts, ["id"]),
        q.dq_not_null(facts, ["id", "amount"]),
        q.dq_range(facts, "amount", 0, 10),
        q.dq_accepted_values(facts, "region", ["W", "E", "S"]),
        q.dq_relationship(facts, "id", parent, "id"),
        q.dq_singular(facts.filter("amount > 100"), "nothing_huge"),
        q.dq_reconcile(facts, facts, "amount"),
        q.dq_reconcile(facts, parent, "amount", "other_total"),
        q.dq_status_only(facts, facts, "id", F.col("amount") > 0),
    )
    assert {r.check_name: r.failures for r in suite.collect()} == {
        "unique": 1, "not_null": 1, "range": 2, "accepted": 1, "relationship": 2, "nothing_huge": 0, "reconcile": 0,
        "other_total": 1, "status": 1,
    }


def test_freshness(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2026-01-01 10:00:00' AS ts")
    assert q.dq_freshness(df, "ts", "2026-01-01 12:00:00", 2).first().passed
    assert not q.dq_freshness(df, "ts", "2026-01-01 12:00:01", 2).first().passed
    assert not q.dq_freshness(df.filter("false"), "ts", "2026-01-01 12:00:00", 2).first().passed


def test_enforce_stops_on_failure(facts):
    assert q.enforce(q.dq_unique(facts.filter("id < 3"), ["id"])).first().passed
    with pytest.raises(q.QualityError, match="unique: 1"):
        q.enforce(q.dq_unique(facts, ["id"]))


def test_expectations(facts):
    kept, seen = q.expect(facts, rules(), "t_expect")
    assert kept.count() == 4 and seen.get == {"positive": 2, "known": 1}
    assert rows(q.expect_or_drop(facts, rules()), "id") == [(1,), (3,)]
    assert q.expect_or_fail(facts, {"has_id": F.col("id") > 0}).count() == 4
    with pytest.raises(PySparkException, match="expectation failed: positive"):
        q.expect_or_fail(facts, rules()).collect()


def test_schema_contract(facts):
    wanted = T.StructType.fromDDL("id int, amount string, status string")
    assert rows(q.schema_contract(facts, wanted), "column_name", "verdict") == [
        ("amount", "type"), ("id", "ok"), ("region", "extra"), ("status", "missing"),
    ]
    with pytest.raises(q.QualityError):
        q.conform(facts, wanted, evolve=True)
    grown = q.conform(facts, T.StructType.fromDDL("id int, amount double, status string"), evolve=True)
    assert grown.columns == ["id", "amount", "status", "region"] and grown.filter("status IS NOT NULL").isEmpty()
    with pytest.raises(q.QualityError):
        q.conform(facts, T.StructType.fromDDL("id int, amount double"))
