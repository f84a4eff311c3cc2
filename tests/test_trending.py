"""Frequent items of a stream with bounded state."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans.catalog import QUERIES
from millrace.streaming import streams as S
from millrace.streaming import trending
from tests.conftest import rows

SCHEMA = "ts timestamp, item string"


def summaries(spark, tmp_path, events, tracked):
    made = spark.createDataFrame(events, "hour double, item string")
    ts = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("hour") * 3600).alias("ts")
    made.select(ts, "item").repartition(3).write.parquet(f"{tmp_path}/in")
    stream = trending.slide_summaries(S.stream_files(spark, f"{tmp_path}/in", SCHEMA), "ts", "6 hours", "1 hour", "item", tracked)
    query = S.run_to_end(S.change_log(stream, f"{tmp_path}/log"), f"{tmp_path}/checkpoint")
    state = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])
    return S.read_change_log(spark, f"{tmp_path}/log", stream.schema, ["window_start"]), state


def events(rare):
    r = random.Random(1)
    heavy = [(r.uniform(0, 18), w) for w, n in (("a", 900), ("b", 700), ("c", 600)) for _ in range(n)]
    return heavy + [(r.uniform(0, 18), f"rare{i}") for i in range(rare)]


def test_many_rare_items_do_not_grow_the_state(spark, tmp_path):
    data = events(20_000)
    found, state = summaries(spark, tmp_path, data, 1000)
    assert state <= 3 and found.count() == 3
    for start, group in ((0, "2024-01-01 00:00:00"), (6, "2024-01-01 06:00:00")):
        inside = Counter(item for h, item in data if start <= h < start + 12)
        top = trending.sliding_top(found, "6 hours", 2, "item", 3).filter(F.col("window_start") == F.lit(group).cast("timestamp"))
        got = {x.item: x.n for x in top.collect()}
        assert list(got) and set(got) == {"a", "b", "c"}
        assert all(abs(got[w] - inside[w]) <= 3.5 * sum(inside.values()) / 1000 for w in got)


def test_few_items_are_counted_exactly_and_decay(spark, tmp_path):
    data = events(50)
    found, _ = summaries(spark, tmp_path, data, 1000)
    counts = [Counter(item for h, item in data if 6 * i <= h < 6 * i + 6) for i in range(3)]
    both = counts[1] + counts[2]
    top = trending.sliding_top(found, "6 hours", 2, "item", 3).filter(F.col("window_start") == F.lit("2024-01-01 06:00:00").cast("timestamp"))
    assert rows(top, "item", "n") == sorted(both.most_common(3))
    best = trending.decayed_top(found, F.lit("2024-01-01 18:00:00"), "6 hours", "item", 2).collect()
    want = {w: counts[2][w] + counts[1][w] / 2 + counts[0][w] / 4 for w in ("a", "b", "c")}
    assert [(x.item, round(x.score, 6)) for x in best] == sorted(want.items(), key=lambda x: -x[1])[:2]
    early = trending.decayed_top(found, F.lit("2024-01-01 06:00:00"), "6 hours", "item", 1).first()
    assert (early.item, early.score) == counts[0].most_common(1)[0]


def test_rare_items_are_counted_exactly(spark, tmp_path):
    """Far more items than a sketch tracks, with counts that differ by one: without a limit none is left out."""
    data = events(20_000) + [(7 + i / 10_000, f"near{i % 3000}") for i in range(3000 * 4 + 2)]
    summaries(spark, tmp_path, data, None)
    schema = "window_start timestamp, window_end timestamp, item string, n long"
    found = S.read_change_log(spark, f"{tmp_path}/log", T.StructType.fromDDL(schema), ["window_start", "item"])
    for start, group in ((0, "2024-01-01 00:00:00"), (6, "2024-01-01 06:00:00"), (12, "2024-01-01 12:00:00")):
        inside = Counter(item for h, item in data if start <= h < start + 12)
        want = sorted(inside.items(), key=lambda x: (-x[1], x[0]))[:500]
        top = trending.sliding_top(found, "6 hours", 2, "item", 500).filter(F.col("window_start") == F.lit(group).cast("timestamp"))
        assert [(x.item, x.n) for x in top.orderBy("rn").collect()] == want
    counts = [Counter(item for h, item in data if 6 * i <= h < 6 * i + 6) for i in range(3)]
    scores = {w: counts[2][w] + counts[1][w] / 2 + counts[0][w] / 4 for w in set().union(*counts)}
    best = trending.decayed_top(found, F.lit("2024-01-01 18:00:00"), "6 hours", "item", 500).collect()
    assert [(x.item, x.score) for x in best] == sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:500]


def test_query_finds_the_first_of_very_many_users(spark, tmp_path):
    """Every user has one event in the first slide but the last three, who have two."""
    users = [*range(5000), 4997, 4998, 4999]
    made = spark.createDataFrame([(i, u) for i, u in enumerate(users)], "event_id long, user_id long")
    ts = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("event_id")).cast("timestamp_ntz").alias("ts")
    made.select("event_id", ts, "user_id", F.lit("x").alias("event_type"), F.lit(1.0).alias("value"), F.lit("").alias("props")).repartition(
        3
    ).write.parquet(f"{tmp_path}/events.parquet")
    found = QUERIES["stream_sliding_trending"](spark, str(tmp_path))
    assert rows(found, "user_id", "n", "rn") == sorted([(4997, 2, 1), (4998, 2, 2), (4999, 2, 3)] * 2)
