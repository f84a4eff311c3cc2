"""Aggregates that are kept up to date from the change alone.

A state has one row per group: rows, known values, their sum, the least and the greatest value and how often each
occurs, and a histogram of the values in buckets of constant ratio. A delta is a set of rows with a sign: plus for rows that came, minus
for rows that went; an update is both. States and deltas add up in any order. Only a group that loses all copies of its
least or greatest value has to be read again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import money
from millrace.operators.joins import null_safe_join
from millrace.session import checkpoint_root, scratch_path

SIGN = "_sign"
#: Buckets of the histogram: a quantile is off by this share of its value at most.
ERROR = 0.01
STATE = ["n", "n_values", "total", "lowest", "n_lowest", "highest", "n_highest", "histogram"]


def signed(inserted: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """A delta of rows that came and rows that went."""
    plus = inserted.withColumn(SIGN, F.lit(1))
    return plus if deleted is None else plus.unionByName(deleted.withColumn(SIGN, F.lit(-1)))


def _bucket(value: Column) -> Column:
    """Sign and logarithm of a value, so that a bucket's ends differ by a constant ratio; zero has its own bucket."""
    step = math.log((1 + ERROR) / (1 - ERROR))
    place = F.ceil(F.log(F.abs(value)) / step).cast("int")
    return F.when(value > 0, F.struct(F.lit(1).alias("side"), place.alias("place"))).when(
        value < 0, F.struct(F.lit(-1).alias("side"), place.alias("place"))
    ).otherwise(F.struct(F.lit(0).alias("side"), F.lit(0).alias("place")))


def _nets(delta: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Net number of rows per group and value. What came and went again cancels out here."""
    rows = delta.select(*keys, F.col(value).alias("_value"), SIGN)
    return rows.groupBy(*keys, "_value").agg(F.sum(SIGN).alias("_net")).filter("_net <> 0")


def _histogram(net: DataFrame, keys: Sequence[str]) -> DataFrame:
    known = net.filter(F.col("_value").isNotNull()).withColumn("_bucket", _bucket(F.col("_value")))
    counts = known.groupBy(*keys, "_bucket").agg(F.sum("_net").alias("_n")).filter("_n <> 0")
    entries = F.array_sort(F.collect_list(F.struct(F.col("_bucket.side").alias("side"), F.col("_bucket.place").alias("place"), F.col("_n").alias("n"))))
    return counts.groupBy(*keys).agg(entries.alias("histogram"))


def _summed(net: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a delta adds to each group. The counts at the extremes are those of the values that came."""
    at = F.when((F.col("_net") > 0) & F.col("_value").isNotNull(), F.struct("_value", "_net"))
    low, high = F.min(at), F.max(at)
    known = F.col("_value").isNotNull()
    sums = net.groupBy(*keys).agg(
        F.sum("_net").alias("n"),
        F.coalesce(F.sum(F.when(known, F.col("_net"))), F.lit(0)).alias("n_values"),
        F.sum(money("_value") * F.col("_net")).cast("decimal(38,2)").alias("total"),
        low["_value"].alias("lowest"), low["_net"].alias("n_lowest"), high["_value"].alias("highest"), high["_net"].alias("n_highest"),
    )
    return null_safe_join(sums, _histogram(net, keys), keys, "left")


def build_state(facts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """State of all rows of ``facts``."""
    return _summed(_nets(signed(facts), keys, value), keys).select(*keys, *STATE)


def _merged_histograms(a: Column, b: Column) -> Column:
    """Entries of both, added up by bucket; both are short and sorted, empty ones go."""
    both = F.concat(F.coalesce(a, F.array()), F.coalesce(b, F.array()))
    place = lambda e: F.struct(e.side, e.place)
    total = lambda p: F.aggregate(F.filter(both, lambda e: place(e) == p), F.lit(0).cast("long"), lambda s, e: s + e.n)
    summed = F.transform(F.array_distinct(F.transform(both, place)), lambda p: F.struct(p.side.alias("side"), p.place.alias("place"), total(p).alias("n")))
    return F.filter(F.array_sort(summed), lambda e: e.n != 0)


def apply_delta(state: DataFrame, delta: DataFrame, facts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The state after ``delta``, from the delta and the old state. The facts are read only if some group lost its least or
    greatest value, and then for those groups alone. ``facts`` holds all rows after the change. Groups without
    rows leave the state; NULL is a group of its own; NULL values count as rows but not as values."""
    spark = state.sparkSession
    checkpoint_root(spark)
    net = _nets(delta, keys, value).checkpoint()
    change = _summed(net, keys).select(*keys, *[F.col(c).alias(f"d_{c}") for c in STATE])
    old = state.select(*keys, *[F.col(c).alias(f"s_{c}") for c in STATE])
    # How many copies of the old extremes came or went.
    ends = null_safe_join(net, old.select(*keys, "s_lowest", "s_highest"), keys, "inner")
    gone = ends.groupBy(*keys).agg(
        F.sum(F.when(F.col("_value") == F.col("s_lowest"), F.col("_net"))).alias("at_lowest"),
        F.sum(F.when(F.col("_value") == F.col("s_highest"), F.col("_net"))).alias("at_highest"),
    )
    change = null_safe_join(change, gone, keys, "left")
    other = change.withColumn("_changed", F.lit(True)).withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    both = old.join(other, same, "full").withColumns({k: F.coalesce(k, f"_r_{k}") for k in keys})
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))

    def extreme(name: str, beats) -> tuple[Column, Column, Column]:
        new, was, count = F.col(f"d_{name}"), F.col(f"s_{name}"), zero(f"s_n_{name}") + zero(f"at_{name}")
        better = new.isNotNull() & (was.isNull() | beats(new, was))
        stays = was.isNotNull() & (count > 0)
        value = F.when(better, new).when(stays, was)
        times = F.when(better, F.col(f"d_n_{name}")).when(stays, count)
        return value, times, ~better & ~stays

    low, n_low, lost_low = extreme("lowest", lambda a, b: a < b)
    high, n_high, lost_high = extreme("highest", lambda a, b: a > b)
    n_values = zero("s_n_values") + zero("d_n_values")
    merged = both.select(
        *keys,
        (zero("s_n") + zero("d_n")).alias("n"),
        n_values.alias("n_values"),
        F.when(n_values > 0, zero("s_total") + zero("d_total")).cast("decimal(38,2)").alias("total"),
        low.alias("lowest"), n_low.alias("n_lowest"), high.alias("highest"), n_high.alias("n_highest"),
        F.when(F.col("_changed"), _merged_histograms(F.col("s_histogram"), F.col("d_histogram"))).otherwise(F.col("s_histogram")).alias("histogram"),
        F.coalesce(F.col("_changed") & (n_values > 0) & (lost_low | lost_high), F.lit(False)).alias("_lost"),
    ).filter("n <> 0")
    path = scratch_path(spark, "state")
    merged.write.parquet(path)
    written = spark.read.schema(merged.schema).parquet(path)
    kept = written.filter(~F.col("_lost")).drop("_lost")
    lost = written.filter("_lost").select(*keys)
    if lost.isEmpty():
        return kept
    again = null_safe_join(facts.select(*keys, value), lost, keys, "left_semi")
    return kept.unionByName(build_state(again, keys, value))


def quantile(state: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """``keys, quantile``: the value below which ``share`` of the group's values lie, within ``ERROR`` of itself."""
    ratio = (1 + ERROR) / (1 - ERROR)
    signed_place = lambda e: e.side * (e.place + 1_000_000)
    ordered = F.array_sort("histogram", lambda a, b: signed_place(a) - signed_place(b))
    rank = F.greatest(F.ceil(F.lit(share) * F.col("n_values")), F.lit(1))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("double").alias("value"))
    middle = lambda e: e.side * F.pow(F.lit(ratio), e.place) * (2 / (1 + ratio))
    step = lambda s, e: F.struct(
        (s.seen + e.n).alias("seen"), F.coalesce(s.value, F.when(s.seen + e.n >= rank, middle(e))).alias("value")
    )
    return state.select(*keys, F.aggregate(ordered, start, step)["value"].alias("quantile"))
