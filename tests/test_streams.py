"""Streams over several micro-batches."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.windows import sessionize
from millrace.plans.catalog import QUERIES
from millrace.streaming import streams as S
from millrace.streaming.alerts import PARTITIONS, breach_alerts, rocksdb_state
from tests.conftest import rows, same_rows

SCHEMA = "id bigint, device int, ts timestamp, value double"


@pytest.fixture
def feed(spark, tmp_path):
    """Ten minutes of readings per file, read one file per micro-batch."""
    path = str(tmp_path / "in")

    def deliver(n, start=0):
        for b in range(n):
            df = spark.range(b * 40, b * 40 + 40).select(
                "id", (F.col("id") % 3).cast("int").alias("device"),
                F.timestamp_seconds(start + b * 600 + (F.col("id") % 40) * 15).alias("ts"),
                ((F.col("id") * 7) % 100).cast("double").alias("value"),
            )
            df.coalesce(1).write.mode("append").parquet(path)

    deliver.path = path
    return deliver


def stream(spark, feed):
    return S.stream_files(spark, feed.path, SCHEMA, files_per_batch=1)


def test_update_log_equals_batch(spark, feed, tmp_path):
    feed(4)
    counts = [F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")]
    agg = S.tumbling(stream(spark, feed), "ts", "7 minutes", "1 hour", ["device"], counts)
    S.run_to_end(S.change_log(agg, str(tmp_path / "log")), str(tmp_path / "cp"))
    got = S.read_change_log(spark, str(tmp_path / "log"), agg.schema, ["window_start", "device"])
    batch = spark.read.parquet(feed.path).groupBy(F.window("ts", "7 minutes").alias("w"), "device").agg(*counts)
    want = batch.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "device", "n", "total")
    assert same_rows(want, got)


def test_restart_continues(spark, feed, tmp_path):
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    feed(2)
    S.run_to_end(S.append_files(stream(spark, feed), out), cp)
    feed(1, start=10_000)
    for _ in range(2):
        S.run_to_end(S.append_files(stream(spark, feed), out), cp)
    assert spark.read.parquet(out).count() == 120


def test_repeated_batch_replaces_itself(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(5).withColumn("v", F.lit(1))
    for _ in range(2):
        S.write_batch(df, path, 0)
    S.write_batch(df.filter("id < 2").withColumn("v", F.lit(2)), path, 1)
    assert S.read_batches(spark, path, df.schema).count() == 7
    latest = [(0, 2), (1, 2), (2, 1), (3, 1), (4, 1)]
    assert rows(S.read_change_log(spark, path, df.schema, ["id"]), "id", "v") == latest
    S.compact_change_log(spark, path, str(tmp_path / "c"), df.schema, ["id"])
    assert S.read_batches(spark, str(tmp_path / "c"), df.schema).count() == 5
    assert rows(S.read_change_log(spark, str(tmp_path / "c"), df.schema, ["id"]), "id", "v") == latest


def test_merge_and_latest_state(spark, feed, tmp_path):
    feed(3)
    merged = S.stream_merge(stream(spark, feed), str(tmp_path / "m"), ["device"], [F.desc("ts"), F.desc("id")])
    S.run_to_end(merged, str(tmp_path / "cp1"))
    state = S.latest_state(stream(spark, feed), ["device"], ["ts", "id"], ["value"])
    S.run_to_end(S.change_log(state, str(tmp_path / "s")), str(tmp_path / "cp2"))
    want = spark.read.parquet(feed.path).groupBy("device").agg(F.max_by("id", F.struct("ts", "id")).alias("id"))
    a = S.read_change_log(spark, str(tmp_path / "m"), T.StructType.fromDDL(SCHEMA), ["device"])
    b = S.read_change_log(spark, str(tmp_path / "s"), state.schema, ["device"])
    assert same_rows(want, a.select("device", "id")) and same_rows(want, b.select("device", "id"))


def test_alerts_are_latched_across_batches(spark, feed, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "FULL_STATE_EVERY", 2)
    feed(4)
    limits = {"min_piece_rows": 5, "max_pieces": 100}
    for name, extra in (("a", {}), ("b", limits)):
        root = str(tmp_path / name)
        writer = S.threshold_alerts(stream(spark, feed), "device", "ts", "id", F.col("value") > 40, root, **extra)
        S.run_to_end(writer, f"{root}/cp")
        got = S.read_batches(spark, f"{root}/alerts", T.StructType.fromDDL(SCHEMA))
        w = "OVER (PARTITION BY device ORDER BY ts, id)"
        spark.read.parquet(feed.path).createOrReplaceTempView("readings")
        want = spark.sql(
            f"""SELECT id FROM (SELECT id, value > 40 AS hit, coalesce(lag(value > 40) {w}, false) AS was FROM readings)
                WHERE hit AND NOT was"""
        )
        assert got.count() > 3 and same_rows(want, got.select("id"))


def test_late_rows_go_aside(spark, feed, tmp_path):
    feed(2, start=100_000)
    feed(1, start=0)
    root = str(tmp_path / "late")
    S.run_to_end(S.split_late(stream(spark, feed), "ts", "1 HOUR", root), f"{root}/cp")
    late = S.read_batches(spark, f"{root}/late", T.StructType.fromDDL(SCHEMA))
    assert late.count() == 40 and late.agg(F.max("ts")).first()[0].year == 1970
    assert spark.read.parquet(f"{root}/on_time").count() == 80


def test_duplicates_in_later_batches_are_dropped(spark, feed, tmp_path):
    feed(1, start=5_000)
    feed(1, start=5_000)
    unique = S.dedup_stream(stream(spark, feed), "ts", "1 hour", ["id"])
    S.run_to_end(S.append_files(unique, str(tmp_path / "out")), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 40


def test_sessions_match_batch(spark, feed, tmp_path):
    feed(1)
    feed(1, start=20_000)
    feed(1, start=90_000)
    found = S.sessions(stream(spark, feed), "ts", "30 minutes", "1 minute", ["device"], [F.count(F.lit(1)).alias("n")])
    S.run_to_end(S.append_files(found, str(tmp_path / "out")), str(tmp_path / "cp"))
    got = spark.read.schema(found.schema).parquet(str(tmp_path / "out"))
    events = spark.read.parquet(feed.path)
    batch = sessionize(events, "device", "ts", "id").groupBy("device", "session_no").agg(
        F.min("ts").alias("session_start"), F.count(F.lit(1)).alias("n")
    )
    closed = batch.filter("session_start < TIMESTAMP'1970-01-01 20:00:00'").select("device", "session_start", "n")
    assert got.count() == 6 and same_rows(closed, got.select("device", "session_start", "n"))


def test_routes_and_hot_cold(spark, feed, tmp_path):
    feed(2)
    paths = {n: str(tmp_path / n) for n in ("low", "high")}
    rules = {"low": F.col("value") < 50, "high": F.col("value") > 30}
    S.run_to_end(S.stream_route(stream(spark, feed), {n: (rules[n], paths[n]) for n in rules}), str(tmp_path / "cp"))
    for n, rule in rules.items():
        assert S.read_batches(spark, paths[n], T.StructType.fromDDL(SCHEMA)).count() == spark.read.parquet(feed.path).filter(rule).count()
    events = stream(spark, feed)
    live = S.tumbling(events, "ts", "1 day", "1 hour", ["device"], [F.count(F.lit(1)).alias("n")])
    hot, cold = S.hot_cold(events, live, "ts", str(tmp_path / "hc"))
    S.run_to_end(hot, str(tmp_path / "cph"))
    S.run_to_end(cold, str(tmp_path / "cpc"))
    assert spark.read.parquet(str(tmp_path / "hc/cold")).filter("event_hour = 0").count() == 80
    assert S.read_change_log(spark, str(tmp_path / "hc/hot"), live.schema, ["window_start", "device"]).agg(F.sum("n")).first()[0] == 80


def test_alerts_run_in_a_session_with_another_state_store(spark, tmp_path):
    """A plain session keeps state in a store without column families; the query brings the one that it needs."""
    day = datetime(2024, 1, 1)
    rows = [(1, day, 7, 60.0), (2, day + timedelta(hours=1), 7, 70.0), (3, day + timedelta(days=20), 7, 80.0), (4, day + timedelta(days=28), 8, 1.0)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame([(i, t, u, "x", v, None) for i, t, u, v in rows], schema).write.parquet(f"{tmp_path}/events.parquet")
    store, parts = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.shuffle.partitions")
    before = spark.conf.get(store)
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    try:
        spark.conf.set(store, plain)
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        found = QUERIES["stream_threshold_alert"](spark, str(tmp_path)).select("event_id").collect()
        assert spark.conf.get(store) == plain
    finally:
        spark.conf.set(store, before)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert sorted(r.event_id for r in found) == [1, 3]


def test_alerts_of_many_devices_take_few_state_rows(spark, tmp_path):
    """Three deliveries that overlap, thousands of devices, one of them NULL, and ids that a float can't hold: the alerts of
    one comparison over all readings, with state rows for shards of devices and not for each."""
    r = random.Random(8)
    devices = [None, *range(2**60, 2**60 + 20), *range(4000)]
    made = [(i, r.randrange(12 * 3600), devices[i] if i < len(devices) else r.choice(devices[:60]), float(r.choice([5, 20]))) for i in range(9000)]
    arrival = lambda i, at: min((at + (1800 if i % 13 == 0 else 0)) // 14400, 2)
    inbox, out = f"{tmp_path}/in", f"{tmp_path}/out"
    start = datetime(2024, 1, 1)
    for n in range(3):
        part = [(i, start + timedelta(seconds=at), d, v) for i, at, d, v in made if arrival(i, at) == n] + ([(-1, None, 3, 20.0)] if n == 1 else [])
        spark.createDataFrame(part, "id long, ts timestamp, device long, v double").write.mode("append").parquet(inbox)
        stream = S.stream_files(spark, inbox, "id long, ts timestamp, device long, v double")
        found = breach_alerts(stream, "device", "ts", "id", F.col("v") > 10, "1 hour", "2 hours")
        with rocksdb_state(spark):
            query = S.run_to_end(S.append_files(found, f"{out}/data"), f"{out}/checkpoint")
        assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) < 2000
    want, last = [], {}
    for i, at, d, v in sorted(made, key=lambda x: (x[1], x[0])):
        was = last.get(d)
        if v > 10 and not (was and was[1] > 10 and at - was[0] <= 7200):
            want.append((i, at, d))
        last[d] = (at, v)
    mark = max(at for _, at, _, _ in made) - 3600
    got = spark.read.schema(found.schema).parquet(f"{out}/data").collect()
    assert sorted((x.id, int((x.ts - start).total_seconds()), x.device) for x in got) == sorted(x for x in want if x[1] <= mark)


def test_streams_with_python_state_begin_with_few_partitions(spark):
    before = spark.conf.get(PARTITIONS)
    try:
        spark.conf.set(PARTITIONS, "200")
        with rocksdb_state(spark):
            assert int(spark.conf.get(PARTITIONS)) == max(spark.sparkContext.defaultParallelism, 8)
        assert spark.conf.get(PARTITIONS) == "200"
    finally:
        spark.conf.set(PARTITIONS, before)
