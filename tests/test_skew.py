"""Ordered calculations and joins with one key that holds most rows."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import aggregates, cdc, joins, scd, windows
from millrace.operators.layout import plan_counts, plan_text
from millrace.operators.skew import _CHUNK, OrderedSplit, heavy_keys, salted_join
from tests.conftest import same_rows

SMALL = {"min_piece_rows": 100, "max_pieces": 1000}


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows share the NULL key; times repeat, ids do not."""
    n = F.col("id")
    key = F.when(n % 2 == 0, F.lit(None)).otherwise(n % 40)
    return spark.range(12_000).select(
        key.alias("k"), F.pmod(F.xxhash64("id"), F.lit(3000)).alias("t"), n.alias("id"), (n % 11).alias("v"),
        F.when(n % 7 == 3, n).alias("sparse"),
    ).cache()


def test_heavy_keys_are_bounded(skewed):
    found = heavy_keys(skewed, ["k"], 100, 50).collect()
    assert {r.k for r in found} >= {None} and len(found) < 50


def test_pieces_are_small(skewed):
    split = OrderedSplit(skewed, ["k"], ["t", "id"], **SMALL)
    sizes = split.df.groupBy("k", _CHUNK).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] < 1000 and sizes[1] > 60


def test_calculations_equal_plain_windows(skewed):
    w = Window.partitionBy("k").orderBy("t", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumns(
        {
            "total": F.sum("v").over(upto),
            "rn": F.row_number().over(w).cast("long"),
            "prev": F.lag("id").over(w),
            "next": F.lead("id").over(w),
            "known": F.last("sparse", True).over(upto),
        }
    )
    split = OrderedSplit(skewed, ["k"], ["t", "id"], **SMALL)
    got = split.running_sum(split.df, {"total": "v"})
    got = split.row_number(got, "rn")
    got = split.previous(got, {"prev": "id"})
    got = split.following(got, {"next": "id"})
    got = split.done(split.last_known(got, "known", "sparse"))
    assert same_rows(want, got)


def test_running_sum_of_nulls(skewed):
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("total", F.sum("sparse").over(w))
    split = OrderedSplit(skewed, ["k"], ["t", "id"], **SMALL)
    assert same_rows(want, split.done(split.running_sum(split.df, {"total": "sparse"})))


def test_no_heavy_key_leaves_one_shuffle_of_the_rows(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    df = windows.running_total(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice")
    df.collect()
    final = plan_text(df, "simple").split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and final.count("Exchange") == 1


def test_sessionize_with_a_heavy_user(skewed):
    events = skewed.select("k", F.timestamp_seconds(F.col("t") * 600).cast("timestamp_ntz").alias("ts"), "id")
    split = windows.sessionize(events, "k", "ts", "id", **SMALL)
    assert same_rows(windows.sessionize(events, "k", "ts", "id"), split)
    w = Window.partitionBy("k").orderBy("ts", "id")
    gap = F.col("ts") - F.lag("ts").over(w) > F.expr("INTERVAL 30 MINUTES")
    plain = events.withColumn("s", F.when(gap | F.lag("ts").over(w).isNull(), 1).otherwise(0))
    plain = plain.withColumn("session_no", F.sum("s").over(w)).drop("s")
    assert same_rows(plain, split)


def test_rank_with_ties(skewed):
    want = skewed.withColumn("rnk", F.rank().over(Window.partitionBy("k").orderBy(F.desc("t"))).cast("long"))
    keyed = skewed.withColumn("k", F.coalesce("k", F.lit(-1)))
    want = want.withColumn("k", F.coalesce("k", F.lit(-1)))
    assert same_rows(want, windows.rank_with_gaps(keyed, ["k"], "t", **SMALL))


def test_group_collect_keeps_everything(skewed):
    lists = aggregates.group_collect(skewed, "k", "id", 50, **SMALL)
    assert lists.filter(F.size("values") > 50).isEmpty()
    assert lists.agg(F.sum(F.size("values"))).first()[0] == skewed.count()


def test_history_with_a_heavy_key(skewed):
    log = skewed.withColumn("_op", F.when(F.col("v") == 0, "D").otherwise("U"))
    plain = cdc.cdc_to_scd2(log, "k", "t", "id", ["v"])
    assert same_rows(plain, cdc.cdc_to_scd2(log, "k", "t", "id", ["v"], **SMALL))
    assert same_rows(
        scd.snapshot_timestamp(skewed, "k", "t", "id", ["v"]),
        scd.snapshot_timestamp(skewed, "k", "t", "id", ["v"], **SMALL),
    )
    loads = skewed.dropDuplicates(["k", "t"])
    loads = loads.select("k", "t", (F.col("t") % 3).alias("v"))
    assert same_rows(scd.snapshot_check(loads, "k", "t", ["v"]), scd.snapshot_check(loads, "k", "t", ["v"], **SMALL))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_point_in_time_equals_range_join(skewed, how):
    keyed = skewed.withColumn("k", F.coalesce("k", F.lit(-1)))
    day = F.date_add(F.lit("2020-01-01"), F.col("t").cast("int"))
    starts = keyed.filter("v = 3").select("k", day.alias("start_date")).distinct()
    versions = starts.withColumn("end_date", F.lead("start_date").over(Window.partitionBy("k").orderBy("start_date")))
    versions = versions.withColumn("label", F.concat_ws("-", "k", "start_date"))
    # Some versions end early, so that facts fall into gaps.
    versions = versions.withColumn("end_date", F.when(F.hash("label") % 3 == 0, F.date_add("start_date", 1)).otherwise(F.col("end_date")))
    facts = keyed.select("k", day.alias("at"), "id")
    inside = (F.col("start_date") <= F.col("at")) & (F.col("end_date").isNull() | (F.col("end_date") > F.col("at")))
    want = facts.alias("f").join(versions.withColumnRenamed("k", "k2"), (F.col("k") == F.col("k2")) & inside, how).drop("k2")
    got = joins.join_point_in_time(facts, versions, "k", "at", unique="id", how=how, **SMALL)
    assert same_rows(want, got)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join(skewed, how):
    big = skewed.withColumn("k", F.when(F.col("id") % 100 == 1, F.lit(None)).otherwise(F.coalesce("k", F.lit(-1))))
    other = big.filter("k < 20").select("k", (F.col("v") * 10).alias("w")).distinct()
    assert same_rows(big.join(other, "k", how), salted_join(big, other, ["k"], how, **SMALL))


def test_full_join(skewed):
    big = skewed.filter("k IS NULL OR k < 30").select("k", "id")
    other = skewed.filter("k > 10").select("k").distinct().withColumn("w", F.col("k") * 2)
    assert same_rows(big.join(other, "k", "full"), joins.join_full(big, other, ["k"]))


def test_top_n_is_pruned_before_the_shuffle(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    top = windows.top_n_per_group(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)
    assert plan_counts(top)["WindowGroupLimit"] == 2
