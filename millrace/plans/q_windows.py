"""Window calculations, sorting, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import joins, windows
from millrace.plans import roles
from millrace.plans.registry import query, table


@query(
    "top_n_per_group",
    f"""WITH {roles.ORDERS} SELECT customer_id, order_id, amount, rn FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY amount DESC, order_id) AS rn FROM ord) WHERE rn <= 3""",
)
def top_n_per_group(spark, sf_dir):
    rows = roles.orders(spark, sf_dir).select("customer_id", "order_id", "amount")
    return windows.top_n_per_group(rows, ["customer_id"], [F.desc("amount"), F.asc("order_id")], 3)


@query(
    "top_n_after_agg",
    """WITH s AS (SELECT p_type, p_partkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
                  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type, p_partkey)
       SELECT p_type, p_partkey, total, rn FROM (
         SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY total DESC, p_partkey) AS rn FROM s) WHERE rn <= 3""",
)
def top_n_after_agg(spark, sf_dir):
    """Lines are added up per part before parts are looked up."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("_s")
    )
    typed = lines.join(table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_partkey")
    return windows.top_n_after_aggregate(typed, ["p_type"], ["p_partkey"], F.sum("_s").cast("double"), 3)


@query(
    "nth_distinct_value",
    """SELECT s_nationkey, s_suppkey, s_acctbal FROM (
         SELECT *, dense_rank() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC) AS rk FROM supplier) WHERE rk = 2""",
)
def nth_distinct_value(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", "s_acctbal")
    return windows.nth_distinct_value(suppliers, ["s_nationkey"], "s_acctbal", 2)


@query(
    "nth_row",
    """SELECT l_orderkey, l_partkey, l_extendedprice FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_linenumber) AS rn
         FROM lineitem) WHERE rn = 2""",
)
def nth_row(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_linenumber")
    order = [F.desc("l_extendedprice"), F.asc("l_partkey"), F.asc("l_linenumber")]
    return windows.nth_row(lines, ["l_orderkey"], order, 2).drop("l_linenumber")


@query(
    "rank_with_gaps",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity,
              rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS rnk FROM lineitem""",
)
def rank_with_gaps(spark, sf_dir):
    """Three keys and fifty values: every group is large and full of ties."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    return windows.rank_with_gaps(lines, ["l_returnflag"], "l_quantity")


@query(
    "running_total",
    f"""WITH {roles.ORDERS} SELECT customer_id, order_id, amount, CAST(sum(CAST(amount AS DECIMAL(18,2))) OVER (
        PARTITION BY customer_id ORDER BY order_ts, order_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
        AS running_total FROM ord""",
)
def running_total(spark, sf_dir):
    rows = roles.orders(spark, sf_dir).select("customer_id", "order_id", "amount", "order_ts")
    return windows.running_total(rows, ["customer_id"], ["order_ts", "order_id"], "amount").drop("order_ts")


@query(
    "lag_previous",
    """SELECT event_id, user_id, lag(ts) OVER w AS prev_ts, lag(event_type) OVER w AS prev_type FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def lag_previous(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    rows = windows.lag_previous(events, ["user_id"], ["ts", "event_id"], {"prev_ts": "ts", "prev_type": "event_type"})
    return rows.drop("ts", "event_type")


@query(
    "lead_next",
    """SELECT event_id, user_id, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM events""",
)
def lead_next(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return windows.lead_next(events, ["user_id"], ["ts", "event_id"], {"next_ts": "ts"}).drop("ts")


@query(
    "growth_mom",
    """WITH months AS (
         SELECT make_date(year(o_orderdate), month(o_orderdate), 1) AS first_day, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS sold
         FROM orders GROUP BY 1)
       SELECT this.first_day AS month_start, CAST(this.sold AS DOUBLE) AS month_total, CAST(before.sold AS DOUBLE) AS month_before,
              round(100.0 * CAST(this.sold - before.sold AS DOUBLE) / NULLIF(CAST(before.sold AS DOUBLE), 0), 1) AS change_percent
       FROM months this LEFT JOIN months before
         ON before.first_day = (SELECT max(x.first_day) FROM months x WHERE x.first_day < this.first_day)""",
)
def growth_mom(spark, sf_dir):
    rows = windows.growth_by_month(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice")
    return rows.toDF("month_start", "month_total", "month_before", "change_percent")


@query(
    "gap_missing_dates",
    """SELECT CAST(dt AS DATE) AS dt FROM generate_series(DATE '2023-12-20', DATE '2024-02-10', INTERVAL 1 DAY) AS s(dt)
       WHERE CAST(dt AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events)""",
)
def gap_missing_dates(spark, sf_dir):
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("d"))
    return joins.missing_dates(days, "d", "2023-12-20", "2024-02-10")


@query(
    "streaks",
    """WITH active AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
       firsts AS (SELECT user_id, day FROM active a WHERE NOT EXISTS (
         SELECT 1 FROM active b WHERE b.user_id = a.user_id AND b.day = a.day - 1)),
       lasts AS (SELECT user_id, day FROM active a WHERE NOT EXISTS (
         SELECT 1 FROM active b WHERE b.user_id = a.user_id AND b.day = a.day + 1))
       SELECT f.user_id, f.day AS first_day, min(l.day) AS last_day, min(l.day) - f.day + 1 AS days
       FROM firsts f JOIN lasts l ON l.user_id = f.user_id AND l.day >= f.day GROUP BY f.user_id, f.day""",
)
def streaks(spark, sf_dir):
    rows = windows.streaks(table(spark, sf_dir, "events"), "user_id", F.col("ts").cast("date"))
    return rows.toDF("user_id", "first_day", "last_day", "days")


@query(
    "sessionize",
    """WITH openers AS (SELECT user_id, ts FROM events a WHERE NOT EXISTS (
         SELECT 1 FROM events b WHERE b.user_id = a.user_id AND b.event_id <> a.event_id
           AND b.ts < a.ts AND b.ts >= a.ts - INTERVAL 30 MINUTE))
       SELECT e.event_id, e.user_id, count(o.ts) AS session_no
       FROM events e JOIN openers o ON o.user_id = e.user_id AND o.ts <= e.ts GROUP BY e.event_id, e.user_id""",
)
def sessionize(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return windows.sessionize(events, "user_id", "ts", "event_id").drop("ts")


@query("order_by_desc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def order_by_desc(spark, sf_dir):
    """The key after the price splits runs of equal prices over range partitions."""
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")


@query("top_k_global", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k_global(spark, sf_dir):
    return order_by_desc(spark, sf_dir).limit(20)


@query(
    "limit_preview",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM lineitem
       ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate LIMIT 10""",
)
def limit_preview(spark, sf_dir):
    """The first rows by key, so that every preview of a table shows the same."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    return table(spark, sf_dir, "lineitem").select(*columns).orderBy(*columns).limit(10)


@query(
    "union_by_name",
    """SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def union_by_name(spark, sf_dir):
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "c_name AS name", "c_mktsegment AS segment")
    s = table(spark, sf_dir, "supplier").selectExpr("s_name AS name", "s_suppkey AS k")
    return c.unionByName(s, allowMissingColumns=True)


@query("union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier UNION SELECT l_linenumber FROM lineitem")
def union_distinct(spark, sf_dir):
    c = table(spark, sf_dir, "customer").selectExpr("c_nationkey AS k")
    s = table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS k")
    return c.union(s).union(table(spark, sf_dir, "lineitem").selectExpr("l_linenumber AS k")).distinct()
