"""Merges, slowly changing dimensions, change logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import cdc, merge, scd, snapshots
from millrace.plans import roles
from millrace.plans.registry import query, table
from millrace.session import scratch_path

CUSTOMER = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
TRACKED = ["c_acctbal", "c_mktsegment"]
KEY, SK = "c_custkey", "customer_sk"
FIRST, SECOND = "2026-01-01", "2026-07-01"

MERGED = f"""WITH {roles.DIM_BATCH} SELECT {CUSTOMER} FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM batch)
             UNION ALL SELECT {CUSTOMER} FROM batch"""


@query("merge_upsert", MERGED)
def merge_upsert(spark, sf_dir):
    """Every batch row arrives twice; the source is made unique first."""
    batch = roles.dim_batch(spark, sf_dir)
    return merge.merge_upsert(table(spark, sf_dir, "customer"), batch.union(batch), [KEY])


@query("staging_delete_insert", MERGED)
def staging_delete_insert(spark, sf_dir):
    return merge.staging_delete_insert(table(spark, sf_dir, "customer"), roles.dim_batch(spark, sf_dir), [KEY])


@query(
    "merge_with_delete",
    f"""WITH {roles.DIM_BATCH}, b AS (SELECT *, c_custkey % 70 = 0 AS gone FROM batch)
        SELECT b.c_custkey, coalesce(c.c_name, b.c_name) AS c_name, coalesce(c.c_nationkey, b.c_nationkey) AS c_nationkey,
               b.c_acctbal, b.c_mktsegment FROM b LEFT JOIN customer c ON b.c_custkey = c.c_custkey WHERE NOT gone
        UNION ALL SELECT {CUSTOMER} FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM b)""",
)
def merge_with_delete(spark, sf_dir):
    op = F.when(F.col(KEY) % 70 == 0, "D").otherwise("U")
    batch = roles.dim_batch(spark, sf_dir).withColumn("_op", op)
    return merge.merge_with_delete(table(spark, sf_dir, "customer"), batch, [KEY], TRACKED)


@query(
    "scd1_validate",
    f"""WITH m AS ({MERGED}) SELECT count(*) AS total_rows, count(DISTINCT c_custkey) AS distinct_keys,
        count(*) = count(DISTINCT c_custkey) AS valid FROM m""",
)
def scd1_validate(spark, sf_dir):
    return scd.scd1_validate(merge_upsert(spark, sf_dir), KEY)


def _dim(spark, sf_dir):
    return scd.scd2_init(table(spark, sf_dir, "customer"), KEY, FIRST, SK)


def _batch(spark, sf_dir):
    return roles.dim_batch(spark, sf_dir).withColumn("effective_date", F.lit(SECOND).cast("date"))


INIT = f"""dim AS (SELECT {CUSTOMER}, DATE '{FIRST}' AS start_date, CAST(NULL AS DATE) AS end_date, true AS is_current,
                   sha256(c_custkey || '||{FIRST}') AS customer_sk FROM customer)"""
CHANGED = """changed AS (SELECT b.* FROM batch b JOIN dim d USING (c_custkey)
  WHERE b.c_acctbal IS DISTINCT FROM d.c_acctbal OR b.c_mktsegment IS DISTINCT FROM d.c_mktsegment)"""
SCD2 = f"""{INIT}, {roles.DIM_BATCH}, {CHANGED},
scd2 AS (
  SELECT {CUSTOMER}, start_date, CASE WHEN c_custkey IN (SELECT c_custkey FROM changed) THEN DATE '{SECOND}' END AS end_date,
         c_custkey NOT IN (SELECT c_custkey FROM changed) AS is_current, customer_sk FROM dim
  UNION ALL
  SELECT {CUSTOMER}, DATE '{SECOND}', NULL, true, sha256(c_custkey || '||{SECOND}') FROM batch
  WHERE c_custkey IN (SELECT c_custkey FROM changed) OR c_custkey NOT IN (SELECT c_custkey FROM dim))"""
SCD2_COLUMNS = f"{CUSTOMER}, start_date, end_date, is_current, customer_sk"


@query("scd2_init", f"WITH {INIT} SELECT {SCD2_COLUMNS} FROM dim")
def scd2_init(spark, sf_dir):
    return _dim(spark, sf_dir)


@query("scd2_detect_changed", f"WITH {INIT}, {roles.DIM_BATCH}, {CHANGED} SELECT {CUSTOMER} FROM changed")
def scd2_detect_changed(spark, sf_dir):
    return scd.scd2_detect_changed(_dim(spark, sf_dir), _batch(spark, sf_dir), KEY, TRACKED).drop("effective_date")


@query("scd2_merge", f"WITH {SCD2} SELECT {SCD2_COLUMNS} FROM scd2")
def scd2_merge(spark, sf_dir):
    return scd.scd2_merge(_dim(spark, sf_dir), _batch(spark, sf_dir), KEY, TRACKED, SK)


@query("scd2_two_step", f"WITH {SCD2} SELECT {SCD2_COLUMNS} FROM scd2")
def scd2_two_step(spark, sf_dir):
    return scd.scd2_two_step(_dim(spark, sf_dir), _batch(spark, sf_dir), KEY, TRACKED, SK)


SOFT = f"""{SCD2}, soft AS (
  SELECT {CUSTOMER}, start_date, customer_sk,
         CASE WHEN is_current AND c_custkey % 70 = 0 THEN DATE '2026-09-01' ELSE end_date END AS end_date,
         is_current AND c_custkey % 70 <> 0 AS is_current FROM scd2)"""


@query("scd2_soft_delete", f"WITH {SOFT} SELECT {SCD2_COLUMNS} FROM soft")
def scd2_soft_delete(spark, sf_dir):
    """Keys divisible by seventy left the source."""
    dim = scd2_merge(spark, sf_dir)
    gone = dim.filter(F.col(KEY) % 70 == 0).select(KEY, F.lit("2026-09-01").cast("date").alias("deleted_on"))
    return scd.scd2_soft_delete(dim, gone, KEY, "deleted_on")


@query("scd2_current", f"WITH {SOFT} SELECT {SCD2_COLUMNS} FROM soft WHERE is_current")
def scd2_current(spark, sf_dir):
    return scd.scd2_current(scd2_soft_delete(spark, sf_dir))


@query("scd2_history", f"WITH {SCD2} SELECT {SCD2_COLUMNS} FROM scd2 WHERE c_custkey = 30")
def scd2_history(spark, sf_dir):
    return scd.scd2_history(scd2_merge(spark, sf_dir), KEY, 30)


@query("scd2_versions", f"WITH {SCD2} SELECT c_custkey, count(*) AS versions FROM scd2 GROUP BY c_custkey")
def scd2_versions(spark, sf_dir):
    return scd.scd2_versions(scd2_merge(spark, sf_dir), KEY)


@query(
    "scd2_as_of",
    f"""WITH {SCD2} SELECT {SCD2_COLUMNS} FROM scd2
        WHERE start_date <= DATE '2026-03-01' AND (end_date > DATE '2026-03-01' OR end_date IS NULL)""",
)
def scd2_as_of(spark, sf_dir):
    return scd.scd2_as_of(scd2_merge(spark, sf_dir), "2026-03-01")


@query(
    "scd2_integrity",
    f"""WITH {SCD2}, k AS (SELECT c_custkey, count(*) FILTER (is_current) AS cur, count(*) AS n,
             count(*) FILTER (is_current = (end_date IS NOT NULL)) AS bad FROM scd2 GROUP BY c_custkey)
        SELECT count(*) FILTER (cur > 1) AS keys_with_two_current, CAST(sum(bad) AS BIGINT) AS bad_end_date,
               count(*) FILTER (n > 1) AS keys_with_history, CAST(sum(n) AS BIGINT) AS total_versions FROM k""",
)
def scd2_integrity(spark, sf_dir):
    return scd.scd2_integrity(scd2_merge(spark, sf_dir), KEY)


@query(
    "scd3_previous_value",
    f"""WITH {roles.DIM_BATCH} SELECT c.c_custkey, b.c_mktsegment,
        CASE WHEN b.c_mktsegment <> c.c_mktsegment THEN c.c_mktsegment END AS prev_c_mktsegment
        FROM customer c JOIN batch b USING (c_custkey)""",
)
def scd3_previous_value(spark, sf_dir):
    dim = table(spark, sf_dir, "customer").select(KEY, "c_mktsegment")
    return scd.scd3_previous_value(dim, roles.dim_batch(spark, sf_dir), KEY, "c_mktsegment")


LOADS = """loads AS (SELECT o_custkey, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)"""


@query(
    "snapshot_timestamp",
    f"""WITH {LOADS} SELECT o_custkey, o_orderpriority, o_orderdate AS valid_from,
        lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to FROM loads""",
)
def snapshot_timestamp(spark, sf_dir):
    """A customer's orders as successive observations of the customer's priority."""
    orders = table(spark, sf_dir, "orders")
    return scd.snapshot_timestamp(orders, "o_custkey", "o_orderdate", "o_orderkey", ["o_orderpriority"])


@query(
    "snapshot_check",
    f"""WITH {LOADS}, s AS (SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS p FROM loads)
        SELECT o_custkey, o_orderpriority, o_orderdate AS valid_from,
        lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to FROM s
        WHERE o_orderpriority IS DISTINCT FROM p""",
)
def snapshot_check(spark, sf_dir):
    from millrace.operators.cleansing import dedup_latest

    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")
    loads = dedup_latest(orders, ["o_custkey", "o_orderdate"], [F.desc("o_orderkey")])
    return scd.snapshot_check(loads, "o_custkey", "o_orderdate", ["o_orderpriority"], weigh=orders)


STATE = "user_id, ts, event_id, event_type, value"
APPLY = f"""WITH {roles.CHANGE_LOG}, r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM log {{where}})
  SELECT {STATE} FROM r WHERE rn = 1 AND _op <> 'D'"""


@query("apply_cdc_log", APPLY.format(where=""))
def apply_cdc_log(spark, sf_dir):
    return cdc.apply_cdc_log(roles.change_log(spark, sf_dir), ["user_id"], ["ts", "event_id"])


@query("state_as_of", APPLY.format(where="WHERE ts <= TIMESTAMP '2024-01-15 12:00:00'"))
def state_as_of(spark, sf_dir):
    """The log comes week by week, late changes with it, with a snapshot every other week; the state reads one and the tail."""
    changes = roles.change_log(spark, sf_dir)
    log = snapshots.SnapshotLog(spark, scratch_path(spark, "log"), changes.schema, ["user_id"], ["ts", "event_id"], every=2)
    week = F.expr("CAST(day(ts) / 7 AS INT) + CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END")
    for version in range(6):
        log.append(changes.filter(week == version), version)
    return log.state_as_of("2024-01-15 12:00:00")


@query(
    "cdc_to_scd2",
    f"""WITH {roles.CHANGE_LOG}, r AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM log)
        SELECT user_id, ts AS effective_at, nxt AS expires_at, nxt IS NULL AS is_current, event_id, event_type, value
        FROM r WHERE _op <> 'D'""",
)
def cdc_to_scd2(spark, sf_dir):
    return cdc.cdc_to_scd2(roles.change_log(spark, sf_dir), "user_id", "ts", "event_id", ["event_type", "value"])


@query(
    "table_diff",
    f"""WITH {roles.DIM_BATCH}, v2 AS (SELECT * FROM batch WHERE c_custkey % 70 <> 0 OR c_custkey < 0)
        SELECT {CUSTOMER}, 'D' AS _op, false AS is_update FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM v2)
        UNION ALL SELECT {CUSTOMER}, 'I', false FROM v2 WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT v2.*, 'U', true FROM v2 JOIN customer c USING (c_custkey)
        WHERE v2.c_acctbal IS DISTINCT FROM c.c_acctbal OR v2.c_mktsegment IS DISTINCT FROM c.c_mktsegment""",
)
def table_diff(spark, sf_dir):
    """Old and new customer tables; keys divisible by seventy are missing from the new one."""
    new = roles.dim_batch(spark, sf_dir).filter((F.col(KEY) % 70 != 0) | (F.col(KEY) < 0))
    return cdc.table_diff(table(spark, sf_dir, "customer"), new, [KEY])


@query(
    "history_report",
    f"WITH {roles.CHANGE_LOG} SELECT CAST(ts AS DATE) AS version, _op, count(*) AS n_rows FROM log GROUP BY 1, 2",
)
def history_report(spark, sf_dir):
    return cdc.history_report(roles.change_log(spark, sf_dir).withColumn("version", F.col("ts").cast("date")), "version")
