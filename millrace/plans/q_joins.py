"""Joins and aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggregates, joins, maintained, scd
from millrace.plans import roles
from millrace.plans.q_rows import clean
from millrace.plans.registry import query, table


@query(
    "join_inner_equi",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def join_inner_equi(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    heads = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"), "inner").drop("o_orderkey")


def _suppliers(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey"), "s_suppkey")


OUTER = """SELECT {key} AS nationkey, n_name, s_suppkey FROM {tables}"""
NATIONS = "(SELECT * FROM nation WHERE n_regionkey < 3)"
SUPPLIERS = "supplier"


def _nations(spark, sf_dir):
    return table(spark, sf_dir, "nation").filter("n_regionkey < 3").select(F.col("n_nationkey").alias("nationkey"), "n_name")


@query("join_left", OUTER.format(key="s_nationkey", tables=f"{SUPPLIERS} LEFT JOIN {NATIONS} ON s_nationkey = n_nationkey"))
def join_left(spark, sf_dir):
    """The large side is the kept side: Spark can broadcast the other or split this one."""
    return _suppliers(spark, sf_dir).join(_nations(spark, sf_dir), "nationkey", "left")


@query("join_right", OUTER.format(key="s_nationkey", tables=f"{NATIONS} RIGHT JOIN {SUPPLIERS} ON s_nationkey = n_nationkey"))
def join_right(spark, sf_dir):
    return _nations(spark, sf_dir).join(_suppliers(spark, sf_dir), "nationkey", "right")


@query(
    "join_full",
    OUTER.format(key="coalesce(s_nationkey, n_nationkey)", tables=f"{NATIONS} FULL JOIN {SUPPLIERS} ON s_nationkey = n_nationkey"),
)
def join_full(spark, sf_dir):
    return joins.join_full(_suppliers(spark, sf_dir), _nations(spark, sf_dir), ["nationkey"])


@query(
    "join_semi",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def join_semi(spark, sf_dir):
    returned = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return joins.rows_with_match(orders, returned, ["o_orderkey"])


@query(
    "join_anti",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def join_anti(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return joins.rows_without_match(orders, lines, ["o_orderkey"])


@query(
    "join_broadcast",
    "SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def join_broadcast(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    regions = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    named = joins.join_broadcast(suppliers, nations, "s_nationkey")
    return joins.join_broadcast(named, regions, "n_regionkey").select("s_suppkey", "n_name", "r_name")


@query(
    "join_salted",
    "SELECT event_id, user_id, c_name FROM events JOIN customer ON user_id = c_custkey",
)
def join_salted(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    return joins.join_salted(events, users, ["user_id"])


@query(
    "join_date_spine",
    """SELECT CAST(dt AS DATE) AS dt, count(o_orderkey) AS n
       FROM generate_series(DATE '1994-12-01', DATE '1995-03-31', INTERVAL 1 DAY) AS s(dt)
       LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(dt AS DATE) GROUP BY 1""",
)
def join_date_spine(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    per_day = orders.groupBy(F.col("o_orderdate").cast("date").alias("dt")).agg(F.count(F.lit(1)).alias("n"))
    spine = joins.date_spine(orders, "1994-12-01", "1995-03-31")
    return spine.join(per_day, "dt", "left").select("dt", F.coalesce("n", F.lit(0)).alias("n"))


def priority_versions(spark, sf_dir):
    """A customer's order priority over time, as dimension versions by day."""
    loads = table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("d"), "o_orderkey", "o_orderpriority"
    )
    versions = scd.snapshot_timestamp(loads, "o_custkey", "d", "o_orderkey", ["o_orderpriority"])
    return versions.select(
        F.col("o_custkey").alias("user_id"), F.col("valid_from").alias("start_date"),
        F.col("valid_to").alias("end_date"), "o_orderpriority",
    )


VERSIONS = """ver AS (
  SELECT o_custkey AS user_id, d AS start_date, lead(d) OVER (PARTITION BY o_custkey ORDER BY d) AS end_date, o_orderpriority
  FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, o_orderpriority,
               row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn
        FROM orders) WHERE rn = 1)"""


def version_starts(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("start_date"))


# Events happen after the last order, so their time is moved back into the order years.
SHIFTED = "CAST(ts - INTERVAL 8 YEAR + (event_id % 1500) * INTERVAL 1 DAY AS TIMESTAMP)"


def shifted_events(spark, sf_dir):
    at = F.col("ts") - F.expr("INTERVAL 8 YEAR") + F.expr("make_dt_interval(CAST(event_id % 1500 AS INT))")
    return table(spark, sf_dir, "events").select("event_id", "user_id", at.alias("happened"))


@query(
    "join_point_in_time",
    f"""WITH {VERSIONS} SELECT event_id, user_id, happened, start_date, end_date, o_orderpriority
        FROM (SELECT event_id, user_id, {SHIFTED} AS happened FROM events) JOIN ver USING (user_id)
        WHERE start_date <= happened AND (end_date > happened OR end_date IS NULL)""",
)
def join_point_in_time(spark, sf_dir):
    return joins.join_point_in_time(
        shifted_events(spark, sf_dir),
        priority_versions(spark, sf_dir),
        "user_id",
        "happened",
        unique="event_id",
        weigh_versions=version_starts(spark, sf_dir),
    )


@query(
    "fact_surrogate_lookup",
    f"""WITH {VERSIONS}, f AS (SELECT event_id, user_id, {SHIFTED} AS happened FROM events)
        SELECT event_id, happened, coalesce(sha256(ver.user_id || '||' || strftime(start_date, '%Y-%m-%d')), 'unknown') AS dim_sk
        FROM f LEFT JOIN ver ON ver.user_id = f.user_id AND start_date <= happened AND (end_date > happened OR end_date IS NULL)""",
)
def fact_surrogate_lookup(spark, sf_dir):
    from millrace.functions.columns import surrogate_key
    from millrace.operators.dimensions import fact_surrogate_lookup as lookup

    dim = priority_versions(spark, sf_dir).withColumn("dim_sk", surrogate_key("user_id", "start_date"))
    return lookup(shifted_events(spark, sf_dir), dim, "user_id", "happened", "dim_sk", "event_id", weigh_versions=version_starts(spark, sf_dir))


@query(
    "join_lookup_scalar",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT avg(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders)",
)
def join_lookup_scalar(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    average = orders.agg((F.sum(F.col("o_totalprice").cast("decimal(18,2)")) / F.count("o_totalprice")).alias("m")).scalar()
    return orders.filter(F.col("o_totalprice") > average)


@query(
    "agg_group_multi",
    """SELECT o_orderpriority, count(*) AS n, CAST(round(sum(CAST(o_totalprice AS DECIMAL(18,2))), 2) AS DOUBLE) AS total,
              CAST(round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS DOUBLE) AS average
       FROM orders GROUP BY o_orderpriority""",
)
def agg_group_multi(spark, sf_dir):
    return aggregates.summarize(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice").orderBy("o_orderpriority")


@query(
    "agg_min_max_global",
    """SELECT min(o_totalprice) AS lowest, max(o_totalprice) AS highest,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n FROM orders""",
)
def agg_min_max_global(spark, sf_dir):
    return aggregates.min_max_total(table(spark, sf_dir, "orders"), "o_totalprice")


@query("agg_count_distinct", "SELECT count(*) AS total_rows, count(DISTINCT l_orderkey) AS distinct_keys FROM lineitem")
def agg_count_distinct(spark, sf_dir):
    return aggregates.rows_and_distinct(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query(
    "agg_having",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def agg_having(spark, sf_dir):
    return aggregates.keys_with_more_than(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], 1)


@query(
    "agg_pivot_conditional",
    f"""WITH {roles.ORDERS} SELECT customer_id,
        CAST(coalesce(sum(CAST(amount AS DECIMAL(18,2))) FILTER (status = 'completed'), 0) AS DOUBLE) AS done_total,
        CAST(coalesce(sum(CAST(amount AS DECIMAL(18,2))) FILTER (status = 'cancelled'), 0) AS DOUBLE) AS void_total
        FROM ord GROUP BY customer_id""",
)
def agg_pivot_conditional(spark, sf_dir):
    values = {"completed": "done_total", "cancelled": "void_total"}
    return aggregates.pivot_sum(roles.orders(spark, sf_dir), ["customer_id"], "status", values, "amount")


SUM_AMOUNT = "CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE)"


@query(
    "revenue_by_region",
    f"""WITH {roles.CLEAN} SELECT coalesce(region, 'Unknown') AS region, {SUM_AMOUNT} AS revenue, count(*) AS orders
        FROM clean JOIN customers USING (customer_id) GROUP BY 1""",
)
def revenue_by_region(spark, sf_dir):
    from millrace.operators.dimensions import build_dim_customer

    dim = build_dim_customer(roles.customers(spark, sf_dir))
    return aggregates.revenue_by(clean(spark, sf_dir), dim, "customer_id", "region")


TOP_PRODUCTS = f"""WITH {roles.CLEAN} SELECT product_id, product_name, category, {SUM_AMOUNT} AS revenue,
        CAST(sum(quantity) AS DOUBLE) AS units
        FROM clean JOIN products USING (product_id) GROUP BY product_id, product_name, category
        ORDER BY revenue DESC, product_id LIMIT 10"""


@query("top_products", TOP_PRODUCTS)
def top_products(spark, sf_dir):
    return aggregates.top_products(clean(spark, sf_dir), roles.products(spark, sf_dir), 10)


@query("daily_revenue", f"WITH {roles.CLEAN} SELECT order_date, {SUM_AMOUNT} AS revenue FROM clean GROUP BY order_date")
def daily_revenue(spark, sf_dir):
    return aggregates.daily_revenue(clean(spark, sf_dir))


@query(
    "revenue_last_period",
    """SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders
       WHERE o_orderdate >= TIMESTAMP '1998-02-01' AND o_orderdate < TIMESTAMP '1998-03-01' GROUP BY o_orderpriority""",
)
def revenue_last_period(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return aggregates.revenue_last_month(orders, "o_orderpriority", "o_orderdate", "o_totalprice", "1998-03-17")


@query("arg_max_key", "SELECT p_partkey, p_retailprice AS value FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 1")
def arg_max_key(spark, sf_dir):
    return aggregates.arg_max(table(spark, sf_dir, "part"), "p_partkey", F.col("p_retailprice"))


@query("repeat_customers", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def repeat_customers(spark, sf_dir):
    return aggregates.keys_with_more_than(table(spark, sf_dir, "orders"), ["o_custkey"], 1)


@query(
    "customer_features",
    """SELECT o_custkey, date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-08-02') AS recency_days, count(*) AS frequency,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS monetary, max(o_totalprice) AS largest,
              count(*) FILTER (o_orderdate >= TIMESTAMP '2001-08-02' - INTERVAL 365 DAY) AS orders_last_year
       FROM orders GROUP BY o_custkey""",
)
def customer_features(spark, sf_dir):
    return aggregates.customer_features(
        table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_totalprice", "2001-08-02"
    )


WORDS = r"""SELECT unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS word FROM documents"""


@query("word_count", f"SELECT word, count(*) AS n FROM ({WORDS}) WHERE word <> '' GROUP BY word")
def word_count(spark, sf_dir):
    return aggregates.word_count(table(spark, sf_dir, "documents"), "text")


@query("most_common", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 5")
def most_common(spark, sf_dir):
    return aggregates.most_common(table(spark, sf_dir, "lineitem"), "l_partkey", 5)


#: The orders after three changes: some came last, some were taken back, some got another price.
CHANGED_ORDERS = """now AS (SELECT CASE WHEN o_custkey % 19 <> 0 THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 33 <> 0 THEN CASE WHEN o_orderkey % 41 = 0 THEN o_totalprice + 1000 ELSE o_totalprice END END AS price
  FROM orders WHERE o_orderkey % 7 <> 0)"""


@query(
    "incremental_aggregate",
    f"""WITH {CHANGED_ORDERS}, ends AS (
          SELECT o_custkey, count(*) AS n, count(price) AS n_values, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total,
                 min(price) AS lowest, max(price) AS highest FROM now GROUP BY o_custkey)
        SELECT ends.*, (SELECT count(*) FROM now x WHERE x.o_custkey IS NOT DISTINCT FROM ends.o_custkey AND x.price = lowest) AS n_lowest
        FROM ends""",
)
def incremental_aggregate(spark, sf_dir):
    """A state of the older orders, then new orders, then deletions and updates; each change reads the state and itself."""
    known = F.when(F.col("o_custkey") % 19 != 0, F.col("o_custkey"))
    price = F.when(F.col("o_orderkey") % 33 != 0, F.col("o_totalprice"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", known.alias("o_custkey"), price.alias("price"))
    cutoff = F.lit("2001-01-01").cast("timestamp_ntz")
    state = maintained.build_state(orders.filter(F.col("o_orderdate") < cutoff), ["o_custkey"], "price")
    came = maintained.signed(orders.filter(F.col("o_orderdate") >= cutoff))
    state = maintained.apply_delta(state, came, orders, ["o_custkey"], "price")
    gone, dearer = F.col("o_orderkey") % 7 == 0, (F.col("o_orderkey") % 41 == 0) & (F.col("o_orderkey") % 7 != 0)
    raised = orders.filter(dearer).withColumn("price", F.col("price") + 1000)
    after = orders.filter(~gone & ~dearer).unionByName(raised)
    change = maintained.signed(raised, orders.filter(gone | dearer))
    state = maintained.apply_delta(state, change, after, ["o_custkey"], "price")
    return state.select("o_custkey", "n", "n_values", F.col("total").cast("double").alias("total"), "lowest", "highest", "n_lowest")


@query(
    "group_collect",
    """SELECT user_id, (rn - 1) // 8 AS list_no, string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) AS days FROM (
         SELECT user_id, d, row_number() OVER (PARTITION BY user_id ORDER BY d) AS rn
         FROM (SELECT user_id, CAST(ts AS DATE) AS d FROM events)) GROUP BY 1, 2""",
)
def group_collect(spark, sf_dir):
    """The day of each event of a user, in lists of eight."""
    days = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("date").cast("string").alias("d"))
    lists = aggregates.group_collect(days, "user_id", "d", 8)
    return lists.select("user_id", "list_no", F.array_join("values", ",").alias("days"))
