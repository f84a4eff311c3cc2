"""Merges and slowly changing dimensions on the small business example."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.operators import cdc, merge, scd
from millrace.operators.layout import plan_text
from millrace.operators.incremental import incremental_model, watermark_increment
from tests.conftest import rows, same_rows

# The example dimension and its change batch.
COLUMNS = "business_id string, name string, city string, state string, category string, stars double, review_count bigint"
BUSINESS = [
    ("B001", "Sunrise Diner", "Phoenix", "AZ", "Restaurants", 4.0, 120),
    ("B002", "Blue Bottle Coffee", "Austin", "TX", "Coffee", 4.5, 300),
    ("B003", "Downtown Gym", "Denver", "CO", "Fitness", 3.5, 80),
    ("B004", "Pizza Palace", "Chicago", "IL", "Restaurants", 4.2, 210),
    ("B005", "Green Leaf Spa", "Seattle", "WA", "Beauty", 4.8, 150),
]
CHANGES = [
    ("B001", "Sunrise Diner", "Phoenix", "AZ", "Restaurants", 4.0, 120),
    ("B002", "Blue Bottle Coffee", "Austin", "TX", "Coffee", 4.7, 350),
    ("B003", "Downtown Gym", "Boulder", "CO", "Fitness", 3.5, 95),
    ("B006", "Taco Fiesta", "Dallas", "TX", "Restaurants", 4.1, 60),
]
TRACKED = ["stars", "city", "review_count"]
KEY, SK = "business_id", "business_sk"


@pytest.fixture(scope="module")
def business(spark):
    return spark.createDataFrame(BUSINESS, COLUMNS)


@pytest.fixture(scope="module")
def changes(spark):
    return spark.createDataFrame(CHANGES, COLUMNS)


@pytest.fixture(scope="module")
def dim(business):
    return scd.scd2_init(business, KEY, "2026-01-01", SK)


@pytest.fixture(scope="module")
def batch(changes):
    return changes.withColumn("effective_date", F.lit("2026-07-01").cast("date"))


@pytest.fixture(scope="module")
def merged(dim, batch):
    return scd.scd2_merge(dim, batch, KEY, TRACKED, SK).cache()


def test_scd1(business, changes):
    after = merge.merge_upsert(business, changes, [KEY])
    assert scd.scd1_validate(after, KEY).first().asDict() == {"total_rows": 6, "distinct_keys": 6, "valid": True}
    assert rows(after.filter("business_id IN ('B002', 'B003')"), "stars", "city", "review_count") == [
        (3.5, "Boulder", 95), (4.7, "Austin", 350),
    ]
    assert same_rows(after, merge.merge_upsert(after, changes, [KEY]))
    assert same_rows(after, merge.staging_delete_insert(business, changes, [KEY]))


def test_repeated_source_key_is_resolved(business, changes):
    twice = changes.withColumn("seq", F.lit(1)).union(changes.withColumns({"stars": F.lit(1.0), "seq": F.lit(2)}))
    after = merge.merge_upsert(business, twice, [KEY], [F.desc("seq")])
    assert after.count() == 6 and after.filter("stars = 1.0").count() == 4


def test_merge_with_delete(business, changes):
    ops = changes.withColumn("_op", F.when(F.col(KEY) == "B001", "D").otherwise("U"))
    gone_unknown = ops.limit(1).withColumns({KEY: F.lit("B999"), "_op": F.lit("D")})
    after = merge.merge_with_delete(business, ops.union(gone_unknown), [KEY], ["stars"])
    assert rows(after, KEY, "stars", "city") == [
        ("B002", 4.7, "Austin"), ("B003", 3.5, "Denver"), ("B004", 4.2, "Chicago"), ("B005", 4.8, "Seattle"), ("B006", 4.1, "Dallas"),
    ]


def test_scd2_expected_states(merged):
    assert merged.count() == 8
    assert dict(rows(scd.scd2_versions(merged, KEY))) == {"B001": 1, "B002": 2, "B003": 2, "B004": 1, "B005": 1, "B006": 1}
    history = rows(scd.scd2_history(merged, KEY, "B002"), "start_date", "end_date", "is_current", "stars")
    assert history == [
        (date(2026, 1, 1), date(2026, 7, 1), False, 4.5), (date(2026, 7, 1), None, True, 4.7),
    ]
    assert rows(scd.scd2_as_of(merged, "2026-03-01").filter("business_id = 'B003'"), "city") == [("Denver",)]
    check = scd.scd2_integrity(merged, KEY).first()
    assert (check.keys_with_two_current, check.bad_end_date, check.keys_with_history) == (0, 0, 2)


def test_scd2_two_ways_agree_and_repeat(dim, batch, merged):
    assert same_rows(merged, scd.scd2_two_step(dim, batch, KEY, TRACKED, SK))
    assert same_rows(merged, scd.scd2_merge(merged, batch, KEY, TRACKED, SK))


def test_small_batch_does_not_shuffle_the_dimension(spark, dim, batch, tmp_path):
    """Written first: rows handed over by the driver have no size estimate."""
    batch.write.parquet(str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b"))
    assert "SortMergeJoin" not in plan_text(scd.scd2_two_step(dim, stored, KEY, TRACKED, SK), "simple")


def test_change_to_null_is_a_change(dim, batch):
    nulled = batch.withColumn("stars", F.lit(None).cast("double"))
    assert scd.scd2_detect_changed(dim, nulled, KEY, TRACKED).count() == 3


def test_untracked_change_makes_no_version(dim, batch):
    renamed = batch.filter("business_id = 'B001'").withColumn("name", F.lit("Sunset Diner"))
    assert scd.scd2_merge(dim, renamed, KEY, TRACKED, SK).count() == 5


def test_soft_deleted_key_can_return(spark, dim, batch):
    gone = spark.createDataFrame([("B001", date(2026, 5, 1))], "business_id string, deleted_on date")
    after = scd.scd2_soft_delete(dim, gone, KEY, "deleted_on")
    assert after.filter("is_current").count() == 4
    back = scd.scd2_merge(after, batch.filter("business_id = 'B001'"), KEY, TRACKED, SK)
    assert rows(back.filter("business_id = 'B001'"), "start_date", "end_date", "is_current") == [
        (date(2026, 1, 1), date(2026, 5, 1), False), (date(2026, 7, 1), None, True),
    ]
    assert same_rows(back, scd.scd2_two_step(after, batch.filter("business_id = 'B001'"), KEY, TRACKED, SK))


def test_scd3(business, changes):
    once = scd.scd3_previous_value(business, changes, KEY, "city")
    assert rows(once.filter("prev_city IS NOT NULL"), KEY, "city", "prev_city") == [("B003", "Boulder", "Denver")]
    assert same_rows(once, scd.scd3_previous_value(once, changes, KEY, "city"))


def test_table_diff(business, changes):
    feed = cdc.table_diff(business, changes, [KEY])
    assert rows(feed, KEY, "_op", "is_update") == [
        ("B002", "U", True), ("B003", "U", True), ("B004", "D", False), ("B005", "D", False), ("B006", "I", False),
    ]


def test_cdc_log(spark):
    log = spark.createDataFrame(
        [(1, 1, "I", "a"), (1, 2, "U", "b"), (2, 3, "I", "c"), (2, 4, "D", "c"), (1, 5, "U", "d"), (2, 6, "I", "e")],
        "k int, s int, _op string, v string",
    )
    assert rows(cdc.state_as_of(log, ["k"], ["s"], 4), "k", "v") == [(1, "b")]
    assert rows(cdc.apply_cdc_log(log, ["k"], ["s"]), "k", "v") == [(1, "d"), (2, "e")]
    assert same_rows(cdc.apply_cdc_log(log, ["k"], ["s"]), cdc.state_as_of(log, ["k"], ["s"], 6))
    history = cdc.cdc_to_scd2(log.withColumn("u", F.col("s")), "k", "s", "u", ["v"])
    assert rows(history, "k", "effective_at", "expires_at", "is_current", "v") == [
        (1, 1, 2, False, "a"), (1, 2, 5, False, "b"), (1, 5, None, True, "d"), (2, 3, 4, False, "c"), (2, 6, None, True, "e"),
    ]
    assert rows(cdc.history_report(log, "k"), "k", "_op", "n_rows") == [(1, "I", 1), (1, "U", 2), (2, "D", 1), (2, "I", 2)]


def test_increment(spark):
    source = spark.createDataFrame([(1, 1), (2, 2), (3, 2), (4, 3)], "id int, ts int")
    target = source.filter("id <= 2")
    assert rows(watermark_increment(source, target, "ts"), "id") == [(4,)]
    assert rows(watermark_increment(source, target, "ts", inclusive=True), "id") == [(2,), (3,), (4,)]
    assert watermark_increment(source, source.filter("id > 9"), "ts").count() == 4
    assert same_rows(source, incremental_model(target, source, ["id"], "ts", [F.desc("ts")]))
    assert same_rows(source, incremental_model(None, source, ["id"], "ts", [F.desc("ts")]))
