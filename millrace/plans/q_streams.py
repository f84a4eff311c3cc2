"""Streaming queries, run to the end of their input and compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import money_total
from millrace.plans.registry import query, table
from millrace.session import scratch_path
from millrace.streaming import late, trending
from millrace.streaming import streams as S
from millrace.streaming.alerts import breach_alerts, rocksdb_state

EVENTS = "SELECT * FROM events"


def _events(spark, sf_dir, zoned=True):
    # The file stream wants a folder or a pattern; this pattern fits a file and a folder of just this name.
    schema = table(spark, sf_dir, "events").schema
    stream = S.stream_files(spark, f"{sf_dir}/event[s].parquet", schema)
    return S.with_event_time(stream, "ts") if zoned else stream


#: Events come in weekly deliveries, some of them a delivery late.
ARRIVAL = "CAST(day(ts) / 7 AS INT) + CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END"
ARRIVAL_SQL = "CAST(day(ts) // 7 AS INT) + CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END"
DELIVERIES = 6


def _deliver(spark, sf_dir, start, delayed=True, zoned=False, arrival=None):
    """Deliver the events one part after the other; ``start`` gets the stream and runs it to the
    end of what is there, each time from the same checkpoint."""
    inbox = scratch_path(spark, "inbox")
    events = table(spark, sf_dir, "events").withColumn("_arrival", F.expr(arrival or (ARRIVAL if delayed else "CAST(day(ts) / 7 AS INT)")))
    schema = events.drop("_arrival").schema
    for n in range(DELIVERIES):
        events.filter(F.col("_arrival") == n).drop("_arrival").write.mode("append").parquet(inbox)
        stream = S.stream_files(spark, inbox, schema)
        start(S.with_event_time(stream, "ts") if zoned else stream)
    return schema


def _plain(df, *columns):
    """Back to zone-less times, as in the input."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("stream_files", EVENTS)
def stream_files(spark, sf_dir):
    out = scratch_path(spark, "stream")
    events = _events(spark, sf_dir, zoned=False)
    S.run_to_end(S.append_files(events, f"{out}/data"), f"{out}/checkpoint")
    return spark.read.schema(events.schema).parquet(f"{out}/data")


@query("stream_triggers", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_triggers(spark, sf_dir):
    """A first run by interval, stopped when the input is used up, then an available-now run."""
    out = scratch_path(spark, "triggers")
    events = _events(spark, sf_dir, zoned=False)
    running = S.run_every(S.append_files(events, f"{out}/data"), f"{out}/checkpoint", "1 second")
    running.processAllAvailable()
    running.stop()
    S.run_to_end(S.append_files(events, f"{out}/data"), f"{out}/checkpoint")
    return spark.read.schema(events.schema).parquet(f"{out}/data").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("stream_exactly_once", EVENTS)
def stream_exactly_once(spark, sf_dir):
    """Restarted twice from its checkpoint: no row comes twice."""
    out = scratch_path(spark, "once")
    events = _events(spark, sf_dir, zoned=False)
    for _ in range(3):
        S.run_to_end(S.append_files(events, f"{out}/data"), f"{out}/checkpoint")
    return spark.read.schema(events.schema).parquet(f"{out}/data")


def _logged(spark, stream, label, keys):
    out = scratch_path(spark, label)
    S.run_to_end(S.change_log(stream, f"{out}/log"), f"{out}/checkpoint")
    return S.read_change_log(spark, f"{out}/log", stream.schema, keys)


def _counts():
    return [F.count(F.lit(1)).alias("n")]


@query(
    "stream_tumbling",
    """SELECT time_bucket(INTERVAL 10 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start,
              time_bucket(INTERVAL 10 MINUTE, ts, TIMESTAMP '1970-01-01') + INTERVAL 10 MINUTE AS window_end, event_type, count(*) AS n
       FROM events GROUP BY 1, 2, 3""",
)
def stream_tumbling(spark, sf_dir):
    counts = S.tumbling(_events(spark, sf_dir), "ts", "10 minutes", "1 hour", ["event_type"], _counts())
    return _plain(_logged(spark, counts, "tumbling", ["window_start", "event_type"]), "window_start", "window_end")


@query(
    "stream_sliding_trending",
    """WITH w AS (SELECT unnest([time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01'),
                                 time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL 6 HOUR]) AS window_start,
                         user_id FROM events),
       c AS (SELECT window_start, user_id, count(*) AS n FROM w GROUP BY 1, 2)
       SELECT window_start, window_start + INTERVAL 12 HOUR AS window_end, user_id, n, rn FROM (
         SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, user_id) AS rn FROM c) WHERE rn <= 3""",
)
def stream_sliding_trending(spark, sf_dir):
    """The three most active users of every twelve hours, every six hours."""
    summaries = trending.slide_summaries(_events(spark, sf_dir), "ts", "6 hours", "1 hour", "user_id")
    logged = _logged(spark, summaries, "trending", ["window_start", "item"])
    return _plain(trending.sliding_top(logged, "6 hours", 2, "user_id", 3), "window_start", "window_end")


@query(
    "stream_session",
    """WITH e AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE
                         THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
       g AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM e),
       f AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n
             FROM g GROUP BY user_id, sid)
       SELECT * FROM f WHERE session_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)""",
)
def stream_session(spark, sf_dir):
    """Finished sessions only: append mode holds a session back until the watermark passes its end."""
    out = scratch_path(spark, "sessions")
    found = S.sessions(_events(spark, sf_dir), "ts", "30 minutes", "10 minutes", ["user_id"], _counts())
    S.run_to_end(S.append_files(found, f"{out}/data"), f"{out}/checkpoint")
    return _plain(spark.read.schema(found.schema).parquet(f"{out}/data"), "session_start", "session_end")


@query("stream_dedup", EVENTS)
def stream_dedup(spark, sf_dir):
    """Every event comes twice, in deliveries that run one after the other, and is written once."""
    out = scratch_path(spark, "dedup")

    def run(events):
        twice = events.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
        unique = S.dedup_stream(twice, "ts", "1 hour", ["event_id"])
        S.run_to_end(S.append_files(unique, f"{out}/data"), f"{out}/checkpoint")

    _deliver(spark, sf_dir, run, delayed=False, zoned=True)
    return _plain(spark.read.parquet(f"{out}/data"), "ts")


LATEST = """SELECT user_id, ts, event_id, event_type, value, props FROM (
              SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""


@query("stream_merge", LATEST)
def stream_merge(spark, sf_dir):
    """Deliveries with late events in them: an old event in a new delivery changes nothing."""
    out, latest = scratch_path(spark, "merge"), [F.desc("ts"), F.desc("event_id")]
    schema = _deliver(
        spark,
        sf_dir,
        lambda events: S.run_to_end(S.stream_merge(events, f"{out}/table", ["user_id"], latest), f"{out}/checkpoint"),
    )
    return S.read_change_log(spark, f"{out}/table", schema, ["user_id"], latest)


@query("stream_latest_state", LATEST)
def stream_latest_state(spark, sf_dir):
    latest = S.latest_state(_events(spark, sf_dir, zoned=False), ["user_id"], ["ts", "event_id"], ["event_type", "value", "props"])
    return _logged(spark, latest, "latest", ["user_id"])


@query(
    "stream_late_data",
    f"""WITH e AS (SELECT *, {ARRIVAL_SQL} AS arrival FROM events),
       highs AS (SELECT arrival, max(ts) AS high FROM e GROUP BY arrival),
       before AS (SELECT a.arrival, max(b.high) AS high FROM highs a LEFT JOIN highs b ON b.arrival < a.arrival GROUP BY a.arrival)
       SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS event_date,
              CASE WHEN ts < before.high - INTERVAL 1 HOUR THEN 'late' ELSE 'on_time' END AS target
       FROM e JOIN before USING (arrival)""",
)
def stream_late_data(spark, sf_dir):
    out = scratch_path(spark, "late")
    schema = _deliver(
        spark, sf_dir, lambda events: S.run_to_end(S.split_late(events, "ts", "1 hour", out), f"{out}/checkpoint")
    )
    dated = T.StructType([*schema.fields, T.StructField("event_date", T.DateType())])
    on_time = S.read_batches(spark, f"{out}/on_time", dated).withColumn("target", F.lit("on_time"))
    put_aside = S.read_batches(spark, f"{out}/late", schema).withColumns(
        {"event_date": F.col("ts").cast("date"), "target": F.lit("late")}
    )
    return on_time.unionByName(put_aside).drop(S.BATCH)


@query(
    "stream_late_reprocess",
    f"""WITH e AS (SELECT *, CAST(ts AS DATE) AS event_date, {ARRIVAL_SQL} AS arrival FROM events)
       SELECT event_date, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
              (SELECT count(DISTINCT arrival) FROM e x WHERE x.event_date = e.event_date) AS version
       FROM e GROUP BY event_date, event_type""",
)
def stream_late_reprocess(spark, sf_dir):
    """Late events go back into their days: after each delivery the days with new events are served again, and no others."""
    out = scratch_path(spark, "served")
    schema = table(spark, sf_dir, "events").schema

    def build(events):
        return events.groupBy("event_date", "event_type").agg(F.count(F.lit(1)).alias("n"), money_total("value").alias("total"))

    def run(events):
        S.run_to_end(S.split_late(events, "ts", "1 hour", out), f"{out}/checkpoint")
        late.serve_dates(spark, out, f"{out}/served", schema, "ts", build)

    _deliver(spark, sf_dir, run)
    versions = late.ledger(spark, f"{out}/served_versions").groupBy("event_date").agg(F.max("version").alias("version"))
    return spark.read.parquet(f"{out}/served").join(versions, "event_date").select("event_date", "event_type", "n", "total", "version")


@query(
    "stream_threshold_alert",
    """SELECT event_id, ts, user_id, event_type, value, props FROM (
         SELECT *, lag(value > 50) OVER w AS was, lag(ts) OVER w AS before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
       WHERE value > 50 AND NOT (coalesce(was, false) AND ts - before <= INTERVAL 2 DAY)
         AND ts <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM events)""",
)
def stream_threshold_alert(spark, sf_dir):
    """Deliveries that overlap; each is a run of its own that goes on from the state of the one before. A device that is
    silent for two days is forgotten."""
    out = scratch_path(spark, "alerts")

    def run(events):
        alerts = breach_alerts(events, "user_id", "ts", "event_id", F.col("value") > 50, "1 day", "2 days")
        with rocksdb_state(spark):
            S.run_to_end(S.append_files(alerts, f"{out}/data"), f"{out}/checkpoint")

    overlapping = "CAST((day(ts) * 24 + hour(ts) + CASE WHEN event_id % 13 = 0 THEN 12 ELSE 0 END) / 168 AS INT)"
    _deliver(spark, sf_dir, run, zoned=True, arrival=overlapping)
    return _plain(spark.read.parquet(f"{out}/data"), "ts")


@query(
    "stream_route",
    """SELECT 'errors' AS target, count(*) AS n FROM events WHERE event_type = 'error'
       UNION ALL SELECT 'large', count(*) FROM events WHERE value > 100""",
)
def stream_route(spark, sf_dir):
    out = scratch_path(spark, "route")
    events = _events(spark, sf_dir, zoned=False)
    rules = {"errors": F.col("event_type") == "error", "large": F.col("value") > 100}
    routes = {name: (rule, f"{out}/{name}") for name, rule in rules.items()}
    S.run_to_end(S.stream_route(events, routes), f"{out}/checkpoint")
    parts = [
        S.read_batches(spark, path, events.schema).agg(F.lit(name).alias("target"), F.count(F.lit(1)).alias("n"))
        for name, (_, path) in routes.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "hot_cold_split",
    """SELECT 'hot' AS side, event_type, count(*) AS n FROM events GROUP BY event_type
       UNION ALL SELECT 'cold', event_type, count(*) FROM events GROUP BY event_type""",
)
def hot_cold_split(spark, sf_dir):
    out = scratch_path(spark, "split")
    events = _events(spark, sf_dir)
    live = S.tumbling(events, "ts", "1 day", "1 hour", ["event_type"], _counts())
    hot, cold = S.hot_cold(events, live, "ts", out)
    S.run_to_end(hot, f"{out}/checkpoint_hot")
    S.run_to_end(cold, f"{out}/checkpoint_cold")
    counts = S.read_change_log(spark, f"{out}/hot", live.schema, ["window_start", "event_type"])
    history = S.read_batches(spark, f"{out}/cold", events.schema)
    sides = {"hot": counts.groupBy("event_type").agg(F.sum("n").alias("n")), "cold": history.groupBy("event_type").agg(*_counts())}
    hot_rows, cold_rows = (df.withColumn("side", F.lit(s)) for s, df in sides.items())
    return hot_rows.unionByName(cold_rows)
