"""The given tables in the roles the operators expect, with dirt added by rule.

The order data is clean, so dirt is derived from the keys by arithmetic, the
same way here and in the SQL beside it (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.registry import table

STATUS = "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END"


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty orders with text amount and text time, one pass over ``orders``.

    Adds blank and negative amounts, unknown customers and products, impossible
    dates, older pending copies and newer cancelled copies.
    """
    k, at = F.col("o_orderkey"), F.col("o_orderdate")
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    orphan = -F.col("o_custkey") - 1

    def version(ts, status):
        return F.struct(ts.alias("order_ts"), status.alias("status"))

    own_ts = F.when(k % 53 == 0, "2026-07-35 10:00:00").otherwise(at.cast("string"))
    versions = F.array(
        version(own_ts, F.expr(STATUS)),
        F.when(k % 67 == 0, version((at - F.expr("INTERVAL 1 DAY")).cast("string"), F.lit("pending"))),
        F.when(k % 71 == 0, version((at + F.expr("INTERVAL 1 DAY")).cast("string"), F.lit("CANCELLED"))),
    )
    return table(spark, sf_dir, "orders").select(
        k.alias("order_id"),
        F.when(k % 41 == 0, orphan).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.when(k % 43 == 0, orphan).otherwise(F.col("o_custkey")).alias("product_id"),
        (k % 5 + 1).alias("quantity"),
        F.when(k % 33 == 0, "").when(k % 47 == 0, F.concat(F.lit("-"), amount)).otherwise(amount).alias("amount"),
        F.explode_outer(versions).alias("v"),
    ).filter("v IS NOT NULL").select("order_id", "customer_id", "product_id", "quantity", "amount", "v.status", "v.order_ts")


RAW_ORDERS = f"""raw_base AS (
  SELECT o_orderkey AS k, o_orderdate AS ots, {STATUS} AS status,
         CASE WHEN o_orderkey % 41 = 0 THEN -o_custkey - 1 ELSE o_custkey END AS customer_id,
         CASE WHEN o_orderkey % 43 = 0 THEN -o_custkey - 1 ELSE o_custkey END AS product_id,
         o_orderkey % 5 + 1 AS quantity,
         CASE WHEN o_orderkey % 33 = 0 THEN ''
              WHEN o_orderkey % 47 = 0 THEN '-' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount
  FROM orders),
raw_orders AS (
  SELECT k AS order_id, customer_id, product_id, quantity, amount, status,
         CASE WHEN k % 53 = 0 THEN '2026-07-35 10:00:00' ELSE strftime(ots, '%Y-%m-%d %H:%M:%S') END AS order_ts
  FROM raw_base
  UNION ALL
  SELECT k, customer_id, product_id, quantity, amount, 'pending', strftime(ots - INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S')
  FROM raw_base WHERE k % 67 = 0
  UNION ALL
  SELECT k, customer_id, product_id, quantity, amount, 'CANCELLED', strftime(ots + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S')
  FROM raw_base WHERE k % 71 = 0)"""


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_id, name, region; the region is NULL for some."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.when(F.col("c_custkey") % 19 != 0, F.col("r_name")).alias("region"),
        )
    )


CUSTOMERS = """customers AS (
  SELECT c_custkey AS customer_id, c_name AS name, CASE WHEN c_custkey % 19 <> 0 THEN r_name END AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
    )


PRODUCTS = """products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_retailprice AS unit_price FROM part)"""

TYPED = """typed AS (
  SELECT * REPLACE (TRY_CAST(amount AS DOUBLE) AS amount, lower(status) AS status), TRY_CAST(substr(order_ts, 1, 10) AS DATE) AS order_date
  FROM raw_orders)"""

LATEST = "order_ts DESC, status, amount, customer_id, product_id"

CLEAN = f"""{RAW_ORDERS},
{CUSTOMERS},
{PRODUCTS},
{TYPED},
clean AS (
  SELECT t.* FROM typed t SEMI JOIN products USING (product_id) SEMI JOIN customers USING (customer_id)
  WHERE t.amount > 0 AND t.status = 'completed'
    AND NOT EXISTS (SELECT 1 FROM typed newer WHERE newer.order_id = t.order_id AND newer.order_ts > t.order_ts))"""


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean orders: order_id, customer_id, amount, status, order_ts, order_date."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        F.expr(STATUS).alias("status"),
        F.col("o_orderdate").alias("order_ts"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


ORDERS = f"""ord AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount, {STATUS} AS status,
         o_orderdate AS order_ts, CAST(o_orderdate AS DATE) AS order_date FROM orders)"""


def dim_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full reload of the customer dimension with changes, plus suppliers as new customers.

    Changed segment on every tenth key, NULL balance on every thirtieth.
    """
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    k = F.col("c_custkey")
    changed = c.select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.when(k % 30 != 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(k % 10 == 0, "CHANGED").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    new = s.select(
        (-F.col("s_suppkey") - 1).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    return changed.unionByName(new)


DIM_BATCH = """batch AS (
  SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 30 <> 0 THEN c_acctbal END AS c_acctbal,
         CASE WHEN c_custkey % 10 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment FROM customer
  UNION ALL
  SELECT -s_suppkey - 1, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier)"""


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a change log on users: sign-ups insert, errors delete, the rest update."""
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    return table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", op.alias("_op"), "event_type", "value"
    )


CHANGE_LOG = """log AS (
  SELECT user_id, ts, event_id, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS _op,
         event_type, value FROM events)"""
