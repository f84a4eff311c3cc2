"""Points in time from snapshots and the tail of the log."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from millrace.operators import cdc
from millrace.operators.layout import plan_text
from millrace.operators.snapshots import SnapshotLog
from tests.conftest import rows

SCHEMA = "k string, at long, id long, v long, _op string"


def versions(seed):
    """Nine versions of changes; some are late by up to two versions."""
    r, out = random.Random(seed), [[] for _ in range(9)]
    for i in range(400):
        at = r.randrange(90)
        late = r.choice([0, 0, 0, 0, 1, 2])
        out[min(8, at // 10 + late)].append((r.choice(["a", "b", "c", "d", "e", None]), at, i, r.randrange(9), r.choice("IUUD")))
    return out


def filled(spark, tmp_path, parts, every=3):
    schema = spark.createDataFrame([], SCHEMA).schema
    log = SnapshotLog(spark, str(tmp_path / "log"), schema, ["k"], ["at", "id"], every)
    for n, part in enumerate(parts):
        log.append(spark.createDataFrame(part, SCHEMA), n)
    return log


def test_every_point_equals_the_whole_log(spark, tmp_path):
    parts = versions(1)
    log = filled(spark, tmp_path, parts)
    whole = spark.createDataFrame([x for p in parts for x in p], SCHEMA)
    assert rows(log.index().filter("has_state"), "version") == [(2,), (5,), (8,)]
    for at in (-1, 0, 9, 25, 29, 30, 44, 59, 60, 89):
        assert rows(log.state_as_of(at)) == rows(cdc.state_as_of(whole, ["k"], ["at", "id"], at))


def test_files_before_the_snapshot_are_not_read(spark, tmp_path):
    log = filled(spark, tmp_path, [[(k, 10 * n + i, n, n, "U") for i, k in enumerate("abc")] for n in range(9)])
    assert log.nearest(75) == 5
    plan = plan_text(log.state_as_of(75))
    filters = [x for x in plan.splitlines() if "PartitionFilters" in x]
    assert len(filters) == 2 and any("= 5)" in x for x in filters) and any("> 5)" in x and "<= 8)" in x for x in filters)
    assert rows(log.state_as_of(75), "k", "at") == [("a", 70), ("b", 71), ("c", 72)]
    assert log.nearest(5) == -1


def test_an_unfinished_version_is_written_again(spark, tmp_path):
    parts = versions(2)
    log = filled(spark, tmp_path, parts[:4])
    before = rows(log.state_as_of(1000))
    spark.createDataFrame(parts[4], SCHEMA).write.parquet(f"{log.root}/log/version=4")  # died before the index row
    assert rows(log.state_as_of(1000)) == before
    log.append(spark.createDataFrame(parts[4], SCHEMA), 4)
    log.append(spark.createDataFrame(parts[4], SCHEMA), 4)
    whole = spark.createDataFrame([x for p in parts[:5] for x in p], SCHEMA)
    assert rows(log.state_as_of(1000)) == rows(cdc.state_as_of(whole, ["k"], ["at", "id"], 1000))


def test_a_late_change_does_not_bring_a_deleted_key_back(spark, tmp_path):
    log = filled(spark, tmp_path, [[("a", 5, 1, 1, "I")], [("a", 9, 2, 1, "D")], [("a", 7, 3, 4, "U")]], every=2)
    assert log.state_as_of(20).isEmpty()
    assert rows(log.state_as_of(8), "k", "v") == [("a", 4)]
