"""Compaction of small files, digests of versions, alerts with keyed state."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import cdc, compaction
from millrace.streaming import streams as S
from millrace.streaming.alerts import breach_alerts
from tests.conftest import rows


def names(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, files in os.walk(path)
        for f in files
        if f.endswith(".parquet") and "_staged" not in d
    }


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"), F.concat(F.lit("0"), F.col("id") % 2).alias("p"))
    df.filter("id < 30000").coalesce(1).write.partitionBy("p").parquet(path)
    df.filter("id >= 30000").repartition(12).write.mode("append").partitionBy("p").parquet(path)
    return path


def target(spark, path):
    return compaction.data_files(spark, path).agg(F.max("length")).first()[0]


def everything(spark, path):
    return spark.read.parquet(path).agg(F.count("*"), F.sum("id"), F.count_distinct("id"), F.max("p").cast("string")).first()


def test_only_small_files_are_merged_and_a_rerun_does_nothing(spark, folder):
    before, want, big = names(folder), everything(spark, folder), target(spark, folder)
    large = {f for f in before if os.path.getsize(f) > big // 2}
    assert compaction.compact_small_files(spark, folder, ["p"], big) == 24
    after = names(folder)
    assert everything(spark, folder) == want and len(after) < 8
    assert {f: after.get(f) for f in large} == {f: before[f] for f in large}
    assert not [f for f in os.listdir(folder) if f.startswith("_") and f != "_SUCCESS"]
    assert compaction.compact_small_files(spark, folder, ["p"], big) == 0 and names(folder) == after


def test_passes_of_few_files_end_the_same(spark, folder):
    want = everything(spark, folder)
    compaction.compact_small_files(spark, folder, ["p"], target(spark, folder), files_per_pass=5)
    assert everything(spark, folder) == want and len(names(folder)) < 8


@pytest.mark.parametrize("steps", [0, 1, 2, 9])
def test_a_killed_swap_is_finished(spark, folder, monkeypatch, steps):
    """Killed after some of two moves and more than twenty deletions."""
    want, done = everything(spark, folder), [0]

    def dying(call):
        def step(self, *paths):
            if compaction.COMMITTED not in paths[-1]:
                done[0] += 1
                if done[0] > steps:
                    raise KeyboardInterrupt
            call(self, *paths)

        return step

    monkeypatch.setattr(compaction._Files, "move", dying(compaction._Files.move))
    monkeypatch.setattr(compaction._Files, "delete", dying(compaction._Files.delete))
    with pytest.raises(KeyboardInterrupt):
        compaction.compact_small_files(spark, folder, ["p"], target(spark, folder))
    monkeypatch.undo()
    assert compaction.finish_replacement(spark, folder)
    assert everything(spark, folder) == want
    assert not compaction.finish_replacement(spark, folder)


def test_a_run_killed_before_the_commit_changes_nothing(spark, folder, monkeypatch):
    before = names(folder)

    def killed(self, path, text):
        raise KeyboardInterrupt

    monkeypatch.setattr(compaction._Files, "write", killed)
    with pytest.raises(KeyboardInterrupt):
        compaction.compact_small_files(spark, folder, ["p"], target(spark, folder))
    assert names(folder) == before


VERSION = "k long, a string, b double"


def versions(spark):
    old = [(i, str(i % 7), float(i)) for i in range(2000)] + [(None, "x", None)]
    new = [(k, a, None if k == 5 else b) for k, a, b in old if k != 9] + [(5000, None, 1.0)]
    new = [(k, None, 3.0) if k == 11 else (k, a, b) for k, a, b in new]
    return spark.createDataFrame(old, VERSION), spark.createDataFrame(new, VERSION)


def test_table_diff_by_digests(spark):
    old, new = versions(spark)
    feed = cdc.table_diff(old, new, ["k"], leaves=512)
    assert rows(feed.filter("k IS NOT NULL"), "k", "_op") == [(11, "U"), (5, "U"), (5000, "I"), (9, "D")]
    assert cdc.table_diff(old, old, ["k"]).isEmpty()


def test_unchanged_buckets_are_not_joined(spark):
    old, new = versions(spark)
    digests = [cdc.bucket_digests(v, ["k"], 512) for v in (old, new)]
    unlike = cdc.differing_leaves(*digests, fan_out=32)
    assert 1 <= unlike.count() <= 4
    assert cdc.rows_in_leaves(old, ["k"], unlike, 512).count() < 40
    moved = spark.createDataFrame([(1, None, 2.0), (2, "z", None)], VERSION), spark.createDataFrame([(1, "z", 2.0), (2, None, None)], VERSION)
    assert cdc.table_diff(*moved, ["k"]).count() == 2
    kept = cdc.table_diff(old, new, ["k"], *digests, leaves=512)
    assert kept.exceptAll(cdc.table_diff(old, new, ["k"])).isEmpty()


def alerts(spark, tmp_path, deliveries):
    inbox, out = str(tmp_path / "inbox"), str(tmp_path / "out")
    schema = "id long, ts timestamp, device string, v double, note string"
    for part in deliveries:
        made = [(i, f"2024-01-01 {h}", d, v, "n" if v > 1 else None) for i, h, d, v in part]
        df = spark.createDataFrame(made, "id long, ts string, device string, v double, note string")
        df.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(inbox)
        stream = S.stream_files(spark, inbox, schema)
        found = breach_alerts(stream, "device", "ts", "id", F.col("v") > 10, "1 hour", "3 hours")
        S.run_to_end(S.append_files(found, f"{out}/data"), f"{out}/checkpoint")  # a new run each time, from the same state
    return [r.id for r in spark.read.schema(found.schema).parquet(f"{out}/data").orderBy("id").collect()]


def test_one_alert_for_a_breach_however_it_is_delivered(spark, tmp_path):
    first = [(1, "00:00:00", "a", 20.0), (3, "00:20:00", "a", 20.0), (4, "00:10:00", None, 11.0)]
    # Reading 2 comes late, between 1 and 3, and ends the breach there; 5 goes on with the breach of 3 after a restart.
    second = [(2, "00:10:00", "a", 1.0), (5, "00:50:00", "a", 30.0), (6, "02:30:00", "b", 1.0)]
    # Device a was silent for three hours when 7 comes: a new alert. 9 is of the device without a name, still remembered.
    third = [(7, "04:00:00", "a", 12.0), (9, "02:00:00", None, 12.0), (10, "02:00:00.5", "b", 50.0), (8, "09:00:00", "z", 0.0)]
    assert alerts(spark, tmp_path, [first, second, third]) == [1, 3, 4, 7, 10]
