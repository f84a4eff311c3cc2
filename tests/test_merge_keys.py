"""NULLs in keys, and equal and different source rows of one key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators.layout import plan_counts
from millrace.operators.merge import merge_upsert, merge_with_delete, staging_delete_insert
from tests.conftest import rows

KIND = "a int, b string, v double, w array<int>"


def test_a_null_key_is_replaced_and_not_doubled(spark):
    target = spark.createDataFrame([(1, None, 1.0, [1]), (None, None, 2.0, None), (2, "x", 3.0, [])], KIND)
    source = spark.createDataFrame([(None, None, 9.0, [1, None]), (1, None, 8.0, None), (1, None, 8.0, None), (3, "x", 7.0, None)], KIND)
    want = rows(spark.createDataFrame([(None, None, 9.0, [1, None]), (1, None, 8.0, None), (2, "x", 3.0, []), (3, "x", 7.0, None)], KIND))
    assert rows(merge_upsert(target, source, ["a", "b"])) == want
    assert rows(staging_delete_insert(target, source.distinct(), ["a", "b"])) == want
    marked = source.selectExpr("*", "if(a is null, 'D', 'U') _op")
    got = rows(merge_with_delete(target, marked, ["a", "b"], ["v"]))
    assert got == rows(spark.createDataFrame([(1, None, 8.0, [1]), (2, "x", 3.0, []), (3, "x", 7.0, None)], KIND))


def test_rows_that_differ_in_the_place_of_a_null_are_different(spark):
    target = spark.createDataFrame([], "a int, v int, w int")
    source = spark.createDataFrame([(None, 1, None), (None, None, 1)], "a int, v int, w int")
    with pytest.raises(Exception, match="several source rows for key NULL"):
        merge_upsert(target, source, ["a"]).collect()


def test_the_source_is_shuffled_once(spark):
    source = spark.createDataFrame([(1, 2)], "a int, v int")
    target = spark.range(10).selectExpr("cast(id as int) a", "cast(id as int) v")
    one = merge_upsert(target, source, ["a"]).filter("v > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert one.count("Window") == 0 and one.count("Aggregate") == 2


def test_keys_of_a_large_batch_are_not_broadcast(spark):
    """Its files are estimated small, but its keys would fill a table of hundreds of megabytes in every task."""
    target = spark.range(1_000_000).withColumn("v", F.lit(1))
    for n, broadcasts in ((600_000, 0), (1000, 1)):
        merged = merge_upsert(target, spark.range(n).withColumn("v", F.lit(2)), ["id"], [F.desc("v")])
        assert plan_counts(merged)["BroadcastHashJoin"] == broadcasts
        assert merged.count() == 1_000_000 and merged.filter("v = 2").count() == n
