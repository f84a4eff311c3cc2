"""Data quality, masking, retention, layout jobs and the model graph."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators import aggregates, cleansing, compaction, dimensions, layout, quality, security, tokens
from millrace.plans import roles
from millrace.plans.models import Model, run_models
from millrace.plans.q_rows import clean
from millrace.plans.registry import query, table
from millrace.session import scratch_name, scratch_path
from millrace.sources import writers


def check_sql(name: str, count: str) -> str:
    return f"SELECT '{name}' AS check_name, n AS failures, n = 0 AS passed FROM ({count})"


def _typed(spark, sf_dir):
    return cleansing.type_orders(roles.raw_orders(spark, sf_dir))


WITH_TYPED = f"WITH {roles.RAW_ORDERS}, {roles.TYPED} "


@query("dq_unique", WITH_TYPED + check_sql("unique", "SELECT count(*) AS n FROM (SELECT order_id FROM typed GROUP BY order_id HAVING count(*) > 1)"))
def dq_unique(spark, sf_dir):
    return quality.dq_unique(_typed(spark, sf_dir), ["order_id"])


@query("dq_not_null", WITH_TYPED + check_sql("not_null", "SELECT count(*) AS n FROM typed WHERE order_id IS NULL OR amount IS NULL"))
def dq_not_null(spark, sf_dir):
    return quality.dq_not_null(_typed(spark, sf_dir), ["order_id", "amount"])


@query("dq_positive", WITH_TYPED + check_sql("positive", "SELECT count(*) AS n FROM typed WHERE NOT coalesce(amount > 0, false)"))
def dq_positive(spark, sf_dir):
    return quality.dq_positive(_typed(spark, sf_dir), "amount")


@query("dq_range", check_sql("range", "SELECT count(*) AS n FROM lineitem WHERE l_quantity NOT BETWEEN 2 AND 49"))
def dq_range(spark, sf_dir):
    return quality.dq_range(table(spark, sf_dir, "lineitem"), "l_quantity", 2, 49)


@query(
    "dq_relationship",
    WITH_TYPED + check_sql("relationship", "SELECT count(*) AS n FROM typed WHERE customer_id NOT IN (SELECT c_custkey FROM customer)"),
)
def dq_relationship(spark, sf_dir):
    return quality.dq_relationship(_typed(spark, sf_dir), "customer_id", table(spark, sf_dir, "customer"), "c_custkey")


@query(
    "dq_accepted_values",
    check_sql("accepted", "SELECT count(*) AS n FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')"),
)
def dq_accepted_values(spark, sf_dir):
    return quality.dq_accepted_values(table(spark, sf_dir, "events"), "event_type", ["click", "view", "purchase"])


@query(
    "dq_status_only",
    f"""WITH {roles.CLEAN} {check_sql("status", "SELECT count(*) AS n FROM typed WHERE order_id NOT IN (SELECT order_id FROM clean)")}""",
)
def dq_status_only(spark, sf_dir):
    """Applied to the raw rows it counts everything that cleaning has to remove."""
    return quality.dq_status_only(_typed(spark, sf_dir), clean(spark, sf_dir), "order_id", F.col("status") == "completed")


@query(
    "dq_reconcile",
    f"""WITH {roles.CLEAN}, a AS (SELECT sum(CAST(amount AS DECIMAL(18,2))) AS x FROM clean),
        b AS (SELECT sum(CAST(amount AS DECIMAL(18,2))) AS y FROM (SELECT order_id, amount FROM clean GROUP BY ALL))
        SELECT 'reconcile' AS check_name, CAST(x <> y AS BIGINT) AS failures, x = y AS passed FROM a, b""",
)
def dq_reconcile(spark, sf_dir):
    """The written facts against the cleaned rows they came from."""
    path, cleaned = scratch_path(spark, "fact_orders"), clean(spark, sf_dir)
    dimensions.build_fact_orders(cleaned).write.parquet(path)
    return quality.dq_reconcile(spark.read.parquet(path), cleaned, "amount")


@query(
    "dq_freshness",
    """SELECT 'freshness' AS check_name, CAST(max(ts) < TIMESTAMP '2024-02-01' - INTERVAL 24 HOUR AS BIGINT) AS failures,
              NOT (max(ts) < TIMESTAMP '2024-02-01' - INTERVAL 24 HOUR) AS passed FROM events""",
)
def dq_freshness(spark, sf_dir):
    return quality.dq_freshness(table(spark, sf_dir, "events"), "ts", "2024-02-01 00:00:00", 24)


@query("dq_singular", WITH_TYPED + check_sql("no_negative_amounts", "SELECT count(*) AS n FROM typed WHERE amount < 0"))
def dq_singular(spark, sf_dir):
    return quality.dq_singular(_typed(spark, sf_dir).filter("amount < 0"), "no_negative_amounts")


def _rules():
    return {"positive": F.col("amount") > 0, "dated": F.col("order_date").isNotNull()}


@query(
    "expect",
    WITH_TYPED
    + """SELECT 'positive' AS rule, count(*) - count(*) FILTER (amount > 0) AS violations, count(*) AS n_rows FROM typed
         UNION ALL SELECT 'dated', count(*) - count(order_date), count(*) FROM typed""",
)
def expect(spark, sf_dir):
    """All rows pass and are written; the violations are counted on the way."""
    path = scratch_path(spark, "expected")
    rows, seen = quality.expect(_typed(spark, sf_dir), _rules(), scratch_name("expect"))
    rows.write.parquet(path)
    counts = spark.createDataFrame([(name, seen.get[name]) for name in _rules()], "rule string, violations long")
    return counts.crossJoin(spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")))


@query(
    "expect_or_drop",
    WITH_TYPED + "SELECT order_id, amount, order_date FROM typed WHERE amount > 0 AND order_date IS NOT NULL",
)
def expect_or_drop(spark, sf_dir):
    return quality.expect_or_drop(_typed(spark, sf_dir), _rules()).select("order_id", "amount", "order_date")


@query("expect_or_fail", f"WITH {roles.CLEAN} SELECT order_id, amount FROM clean")
def expect_or_fail(spark, sf_dir):
    return quality.expect_or_fail(clean(spark, sf_dir), {"positive": F.col("amount") > 0}).select("order_id", "amount")


SUITE = {
    "one row per order": "SELECT count(*) AS n FROM (SELECT order_id FROM clean GROUP BY order_id HAVING count(*) > 1)",
    "keys and amounts are there": "SELECT count(*) AS n FROM clean WHERE order_id IS NULL OR amount IS NULL",
    "amounts are positive": "SELECT count(*) AS n FROM clean WHERE amount <= 0",
    "customers exist": "SELECT count(*) AS n FROM clean WHERE customer_id NOT IN (SELECT customer_id FROM customers)",
    "products exist": "SELECT count(*) AS n FROM clean WHERE product_id NOT IN (SELECT product_id FROM products)",
}


def order_checks(facts, customers, products):
    """The gate on the order facts: two row rules in one scan, one key check, two references."""
    unique, nulls, positive, to_customer, to_product = SUITE
    rules = {nulls: F.col("order_id").isNotNull() & F.col("amount").isNotNull(), positive: F.col("amount") > 0}
    return quality.dq_suite(
        quality.row_rules(facts, rules),
        quality.dq_unique(facts, ["order_id"], unique),
        quality.dq_relationship(facts, "customer_id", customers, "customer_id", to_customer),
        quality.dq_relationship(facts, "product_id", products, "product_id", to_product),
    )


@query("dq_suite", f"WITH {roles.CLEAN} " + " UNION ALL ".join(check_sql(n, sql) for n, sql in SUITE.items()))
def dq_suite(spark, sf_dir):
    """The facts are written once, and all checks read the written table."""
    path = scratch_path(spark, "fact_orders")
    dimensions.build_fact_orders(clean(spark, sf_dir)).write.parquet(path)
    report = order_checks(spark.read.parquet(path), roles.customers(spark, sf_dir), roles.products(spark, sf_dir))
    return quality.enforce(report)


@query(
    "mask_columns",
    rf"""SELECT conv_id, turn, CASE WHEN length(role) > 1 THEN repeat('*', length(role) - 1) || right(role, 1) ELSE role END AS role,
                regexp_replace(text, '{C.EMAIL_PATTERN}', '***', 'g') AS text, sha256('pepper' || conv_id) AS token
         FROM conversations""",
)
def mask_columns(spark, sf_dir):
    """Seen by an analyst: text is open to support only, ids are tokens for all but finance."""
    rows = table(spark, sf_dir, "conversations").withColumn("token", F.col("conv_id").cast("string"))
    masks = {
        "text": C.hide_emails("text"),
        "role": C.keep_last("role", 1),
        "token": C.salted_hash("conv_id", "pepper"),
    }
    allowed = {"text": "support", "role": "support", "token": "finance"}
    return security.mask_columns(rows, masks, {"analysts"}, allowed)


@query(
    "row_filter",
    """SELECT c_custkey, c_nationkey, c_acctbal FROM customer
       WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)""",
)
def row_filter(spark, sf_dir):
    """Policy: the analysts of a region see the customers of its nations."""
    policy = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.concat(F.lit("analyst_"), F.col("n_regionkey")).alias("role")
    )
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return security.row_filter(rows, policy, "c_nationkey", "analyst_2")


@query(
    "pii_scan",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{p}' AS pattern, count(*) FILTER (regexp_matches({c}, '{rx}')) AS hits FROM documents"
        for c in ("text", "lang", "source")
        for p, rx in security.PII_PATTERNS.items()
    ),
)
def pii_scan(spark, sf_dir):
    return security.pii_scan(table(spark, sf_dir, "documents"), ["text", "lang", "source"])


#: Numbers of customers: valid cards, numbers like cards, and account numbers of which one in 97 is valid.
NUMBERS = """SELECT c_custkey, concat('card 4000-0000-0000-', a, b, c, check_digit, '.') AS card, concat(lpad(CAST(c_custkey AS VARCHAR(20)), 14, '0'), '7') AS serial,
    concat('to DE', lpad(CAST(c_custkey % 100 AS VARCHAR(20)), 2, '0'), lpad(CAST(c_custkey * 7919 AS VARCHAR(20)), 18, '0'), ';') AS account FROM (
  SELECT c_custkey, a, b, c, CAST((10 - (8 + a + b + c + a - CASE WHEN a > 4 THEN 9 ELSE 0 END + c - CASE WHEN c > 4 THEN 9 ELSE 0 END) % 10) % 10 AS INT) AS check_digit
  FROM (SELECT c_custkey, CAST((c_custkey % 1000 - c_custkey % 100) / 100 AS INT) AS a, CAST((c_custkey % 100 - c_custkey % 10) / 10 AS INT) AS b,
               CAST(c_custkey % 10 AS INT) AS c FROM customer) k) d"""


@query(
    "pii_scan_verified",
    rf"""WITH numbers AS ({NUMBERS}),
         cards AS (
           SELECT 'card' AS column_name, unnest(regexp_extract_all(card, '[0-9](?:[ -]?[0-9]){{12,18}}')) AS v FROM numbers
           UNION ALL SELECT 'serial', unnest(regexp_extract_all(serial, '[0-9](?:[ -]?[0-9]){{12,18}}')) FROM numbers),
         digits AS (SELECT column_name, v, reverse(regexp_replace(v, '[^0-9]', '', 'g')) AS d FROM cards),
         luhn AS (SELECT column_name, 'card' AS kind, v, list_sum(list_transform(range(1, len(d) + 1), lambda i:
             CASE WHEN i % 2 = 1 THEN CAST(d[i] AS INT) WHEN d[i] > '4' THEN 2 * CAST(d[i] AS INT) - 9 ELSE 2 * CAST(d[i] AS INT) END)) % 10 = 0 AS ok
           FROM digits),
         accounts AS (SELECT unnest(regexp_extract_all(account, '[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}')) AS v FROM numbers),
         mod97 AS (SELECT 'account' AS column_name, 'iban' AS kind, v, CAST(v[5:] || '1314' || v[3:4] AS HUGEINT) % 97 = 1 AS ok FROM accounts),
         hits AS (SELECT * FROM luhn UNION ALL SELECT * FROM mod97)
       SELECT column_name, kind, count(*) AS n_candidates, count(*) FILTER (ok) AS n_valid, count(DISTINCT v) FILTER (ok) AS n_distinct,
              CASE WHEN count(*) FILTER (ok) >= 0.5 * count(*) AND count(DISTINCT v) FILTER (ok) >= 10 THEN kind ELSE 'none' END AS verdict
       FROM hits GROUP BY column_name, kind""",
)
def pii_scan_verified(spark, sf_dir):
    """Cards are known by their check digit; serial numbers that look alike are not taken for cards."""
    table(spark, sf_dir, "customer").createOrReplaceTempView("numbered_customer")
    numbers = spark.sql(NUMBERS.replace("FROM customer", "FROM numbered_customer"))
    return security.verified_scan(numbers, ["card", "serial", "account"])


PHONE = "substr(d, 1, 3) || '-' || substr(d, 4, 3) || ' ' || substr(d, 7)"


def _feistel_sql() -> str:
    """The rounds one by one over nine digits, halves of four and five."""
    steps = "r0 AS (SELECT k, substr(d, 1, 4) AS a, substr(d, 5) AS b FROM v)"
    for i in range(tokens.ROUNDS):
        width = 4 if i % 2 == 0 else 5
        number = f"CAST('0x' || substr(sha256('pepper:{i}:9:' || b), 1, 15) AS BIGINT)"
        steps += f", r{i + 1} AS (SELECT k, b AS a, lpad(CAST((CAST(a AS BIGINT) + {number}) % {10**width} AS VARCHAR), {width}, '0') AS b FROM r{i})"
    return f"v AS (SELECT c_custkey AS k, lpad(CAST(c_custkey * 11 AS VARCHAR), 9, '0') AS d FROM customer), {steps}"


@query(
    "mask_tokens",
    f"""WITH {_feistel_sql()}, t AS (SELECT k, a || b AS d FROM r{tokens.ROUNDS})
        SELECT t.k AS c_custkey, (SELECT {PHONE} FROM v WHERE v.k = t.k) AS phone, {PHONE} AS token FROM t""",
)
def mask_tokens(spark, sf_dir):
    """Phone numbers as tokens of the same format; ``phone`` is what comes back from the token with the key."""
    digits = F.lpad((F.col("c_custkey") * 11).cast("string"), 9, "0")
    phone = F.concat(F.substring(digits, 1, 3), F.lit("-"), F.substring(digits, 4, 3), F.lit(" "), F.substring(digits, 7, 3))
    rows = table(spark, sf_dir, "customer").select("c_custkey", tokens.digit_token(phone, "pepper").alias("token"))
    return rows.withColumn("phone", tokens.digit_token(F.col("token"), "pepper", back=True))


@query(
    "retention_purge",
    """SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
       AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def retention_purge(spark, sf_dir):
    """Old orders go, by whole folders of years; so do those of customers in debt, standing in for erasure requests."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    requests = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    path = scratch_path(spark, "orders")
    writers.write_partitioned(orders.withColumn("year", F.year("o_orderdate")), path, ["year"])
    inside = F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp")
    writers.purge_partitions(spark, path, "year", "1997", inside, scratch_path(spark, "orders-kept"))
    kept = security.retention_purge(spark.read.parquet(path).drop("year"), "o_orderdate", "1997-01-01")
    return security.erase_subjects(kept, requests, "o_custkey")


@query(
    "log_search",
    """SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE user_id = 42 AND event_type = 'error'
       AND ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' GROUP BY 1""",
)
def log_search(spark, sf_dir):
    failed = F.col("event_type") == "error"
    return security.log_search(table(spark, sf_dir, "events"), "user_id", 42, "ts", "2024-01-01", "2024-02-01", failed)


LINES = """SELECT * REPLACE (l_discount + 0.0 AS l_discount) FROM lineitem"""


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn("l_discount", F.col("l_discount") + 0.0)


#: Rows of the input for each large file of a folder.
ROWS_PER_FILE = 8_000_000


@query("compact_files", LINES)
def compact_files(spark, sf_dir):
    """Files of the target size, one for a small table, and many small ones in each flag's folder: the small ones are merged
    in place. Files grow in number with the table, not in size."""
    path = scratch_path(spark, "files")
    lines = _lines(spark, sf_dir)
    large = max(1, math.ceil(lines.count() / ROWS_PER_FILE))
    layout.merge_partitions(lines.filter("l_partkey % 2 = 0"), large).write.partitionBy("l_returnflag").parquet(path)
    target = compaction.data_files(spark, path).agg(F.min("length")).first()[0]
    layout.spread_partitions(lines.filter("l_partkey % 2 = 1"), 32 * large).write.mode("append").partitionBy("l_returnflag").parquet(path)
    compaction.compact_small_files(spark, path, ["l_returnflag"], target)
    return layout.read_as_written(spark, path)


@query("zorder_layout", LINES)
def zorder_layout(spark, sf_dir):
    path = scratch_path(spark, "zorder")
    layout.zorder_layout(_lines(spark, sf_dir), ["l_partkey", "l_shipdate", "l_returnflag"]).write.parquet(path)
    return spark.read.parquet(path)


@query("sort_layout", "SELECT * FROM orders")
def sort_layout(spark, sf_dir):
    path = scratch_path(spark, "sorted")
    layout.sort_layout(table(spark, sf_dir, "orders"), ["o_orderdate"]).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "bucket_layout",
    """SELECT o_orderkey, o_orderpriority, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey
       GROUP BY o_orderkey, o_orderpriority""",
)
def bucket_layout(spark, sf_dir):
    """Join and grouping on the bucket column without another shuffle."""
    heads, lines = scratch_name("orders_bucketed"), scratch_name("lines_bucketed")
    orders, detail = table(spark, sf_dir, "orders"), _lines(spark, sf_dir)
    buckets = layout.file_count(detail)  # the larger side decides for both
    layout.bucket_layout(orders, heads, scratch_path(spark, "bo"), ["o_orderkey"], buckets)
    layout.bucket_layout(detail, lines, scratch_path(spark, "bl"), ["l_orderkey"], buckets)
    joined = spark.table(heads).join(spark.table(lines), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query(
    "cache_reuse",
    """SELECT o_orderpriority AS grp, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY 1
       UNION ALL SELECT o_orderstatus, count(*) FROM orders WHERE o_totalprice > 100000 GROUP BY 1""",
)
def cache_reuse(spark, sf_dir):
    """Two reports from one cached selection, written while the cache is held."""
    path = scratch_path(spark, "reports")
    with layout.cached(table(spark, sf_dir, "orders").filter("o_totalprice > 100000")) as big:
        for column in ("o_orderpriority", "o_orderstatus"):
            report = big.groupBy(F.col(column).alias("grp")).agg(F.count(F.lit(1)).alias("n"))
            report.write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query("repartition_coalesce", "SELECT * FROM orders")
def repartition_coalesce(spark, sf_dir):
    """Spread for work on keys, then merged to files of the target size."""
    orders = table(spark, sf_dir, "orders")
    files = layout.file_count(orders)
    return layout.merge_partitions(layout.spread_partitions(orders, 4 * files, ["o_orderkey"]), files)


@query(
    "model_dag",
    f"""WITH {roles.CLEAN} SELECT coalesce(region, 'Unknown') AS region,
        CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS orders
        FROM clean JOIN customers USING (customer_id) GROUP BY 1""",
)
def model_dag(spark, sf_dir):
    """The star schema as a graph of models, the gate running as the fact table's tests. A first
    run builds the facts of the early orders, a second one merges the rest: as a full build."""
    customers, products = roles.customers(spark, sf_dir), roles.products(spark, sf_dir)
    models = [
        Model("mart", lambda fact, dim_customer: aggregates.revenue_by(fact, dim_customer, "customer_id", "region"),
              ("fact", "dim_customer")),
        Model("fact", lambda due: dimensions.build_fact_orders(due), ("due",), "incremental", ("order_id",), "date_key",
              (lambda df: order_checks(df, customers, products),)),
        # Orders without a date are never newer than anything, so they belong to the first run.
        Model("due", lambda clean, until: clean.join(until, F.coalesce(F.col("order_date") <= F.col("last_day"), F.lit(True)))
              .drop("last_day"), ("clean", "until")),
        Model("clean", lambda raw: cleansing.clean_orders(raw, customers, products), ("raw",)),
        Model("dim_customer", dimensions.build_dim_customer, ("customers",)),
    ]
    done = None
    for day in ("1998-06-30", "9999-12-31"):
        until = spark.range(1).select(F.lit(day).cast("date").alias("last_day"))
        sources = {"raw": roles.raw_orders(spark, sf_dir), "customers": customers, "until": until}
        done = run_models(sources, models, spark, scratch_path(spark, "models"), done)
    return done["mart"]
