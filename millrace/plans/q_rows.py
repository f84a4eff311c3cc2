"""Projections, filters, cleansing and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators import cleansing, dimensions, entities, similarity
from millrace.plans import roles
from millrace.plans.registry import query, table


@query(
    "select_rename_drop",
    "SELECT o_orderkey AS order_key, o_totalprice, o_totalprice * 2 AS doubled FROM orders",
)
def select_rename_drop(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn("doubled", F.col("o_totalprice") * 2)
    return rows.withColumnRenamed("o_orderkey", "order_key").drop(
        "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )


@query(
    "filter_conjunctive",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
       WHERE l_quantity > 30 AND l_returnflag = 'A' AND l_extendedprice < 50000""",
)
def filter_conjunctive(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").filter((F.col("l_quantity") > 30) & (F.col("l_returnflag") == "A"))
    return rows.where("l_extendedprice < 50000").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query(
    "filter_in_between",
    """SELECT o_orderkey, o_orderpriority, o_orderdate FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
       AND o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'""",
)
def filter_in_between(spark, sf_dir):
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("1997-01-01", "1997-12-31"))
    rows = table(spark, sf_dir, "orders").filter(F.col("o_orderdate").between(low, high))
    return rows.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", "o_orderpriority", "o_orderdate"
    )


@query(
    "case_tier",
    """SELECT event_id, value, CASE WHEN value * 10 >= 1000 THEN 'high' WHEN value * 10 >= 100 THEN 'medium' ELSE 'low' END
       AS tier FROM events""",
)
def case_tier(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "value", C.tier(F.col("value") * 10).alias("tier"))


@query(
    "explore_status",
    f"""WITH {roles.RAW_ORDERS} SELECT status, count(*) AS n, count(*) - count(NULLIF(amount, '')) AS null_amounts
        FROM raw_orders GROUP BY status""",
)
def explore_status(spark, sf_dir):
    raw = roles.raw_orders(spark, sf_dir).withColumn("amount", C.blank_to_null("amount"))
    return raw.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("amount").isNull()).alias("null_amounts")
    )


@query(
    "apply_mapping",
    f"""WITH {roles.RAW_ORDERS} SELECT order_id AS id, TRY_CAST(amount AS DOUBLE) AS price,
        CAST(quantity AS INTEGER) AS qty, TRY_CAST(status AS INTEGER) AS code FROM raw_orders""",
)
def apply_mapping(spark, sf_dir):
    mapping = [
        ("order_id", "id", "bigint"),
        ("amount", "price", "double"),
        ("quantity", "qty", "int"),
        ("status", "code", "int"),
    ]
    return cleansing.apply_mapping(roles.raw_orders(spark, sf_dir), mapping)


@query(
    "resolve_choice",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS code_int,
              CASE WHEN event_id % 3 = 0 THEN event_type END AS code_string FROM events""",
)
def resolve_choice(spark, sf_dir):
    mixed = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("user_id").cast("string"))
    rows = table(spark, sf_dir, "events").select("event_id", mixed.alias("code"))
    return cleansing.resolve_choice(rows, "code", "make_cols")


@query(
    "type_cast_clean",
    f"WITH {roles.RAW_ORDERS}, {roles.TYPED} SELECT order_id, amount, status, order_date FROM typed",
)
def type_cast_clean(spark, sf_dir):
    return cleansing.type_orders(roles.raw_orders(spark, sf_dir)).select("order_id", "amount", "status", "order_date")


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query(
    "sample_rows",
    "SELECT * FROM orders WHERE CAST('0x' || substr(md5('42:' || o_orderkey), 1, 8) AS BIGINT) < 429496729.6",
)
def sample_rows(spark, sf_dir):
    """A tenth of the orders, the same in every run and however the table is stored."""
    return cleansing.sample_by_key(table(spark, sf_dir, "orders"), ["o_orderkey"], 0.1)


@query("money_rescale", "SELECT o_orderkey, CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DOUBLE) / 100 AS price FROM orders")
def money_rescale(spark, sf_dir):
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return table(spark, sf_dir, "orders").select("o_orderkey", C.cents_to_units(cents).cast("double").alias("price"))


@query(
    "drop_nulls",
    f"""WITH {roles.RAW_ORDERS}, {roles.TYPED} SELECT order_id, amount, order_date FROM typed
        WHERE amount IS NOT NULL AND order_date IS NOT NULL""",
)
def drop_nulls(spark, sf_dir):
    typed = cleansing.type_orders(roles.raw_orders(spark, sf_dir)).select("order_id", "amount", "order_date")
    return cleansing.drop_nulls(typed, ["amount", "order_date"])


@query(
    "fill_nulls",
    f"""WITH {roles.CUSTOMERS} SELECT customer_id, coalesce(region, 'none') AS region FROM customers""",
)
def fill_nulls(spark, sf_dir):
    return cleansing.fill_nulls(roles.customers(spark, sf_dir).select("customer_id", "region"), {"region": "none"})


@query(
    "clamp_negative",
    f"""WITH {roles.RAW_ORDERS}, {roles.TYPED}
        SELECT order_id, CASE WHEN amount < 0 THEN 0.0 ELSE amount END AS amount FROM typed""",
)
def clamp_negative(spark, sf_dir):
    return cleansing.clamp_column(cleansing.type_orders(roles.raw_orders(spark, sf_dir)).select("order_id", "amount"), "amount")


@query(
    "coalesce_unknown",
    f"WITH {roles.CUSTOMERS} SELECT customer_id, coalesce(NULLIF(region, ''), 'Unknown') AS region FROM customers",
)
def coalesce_unknown(spark, sf_dir):
    return cleansing.fill_unknown(roles.customers(spark, sf_dir).select("customer_id", "region"), "region")


@query("drop_duplicates_key", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def drop_duplicates_key(spark, sf_dir):
    """Only the keys are shown, since the choice of row is open."""
    rows = table(spark, sf_dir, "lineitem")
    return cleansing.drop_duplicates_key(rows, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber")


LINE_TIES = ["l_extendedprice", "l_partkey", "l_suppkey", "l_discount", "l_tax", "l_quantity", "l_returnflag", "l_linestatus"]


@query(
    "dedup_latest",
    f"""SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_partkey FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                       ORDER BY l_shipdate DESC, {", ".join(LINE_TIES)}) AS rn FROM lineitem)
        WHERE rn = 1""",
)
def dedup_latest(spark, sf_dir):
    latest = [F.desc("l_shipdate"), *[F.asc(c) for c in LINE_TIES]]
    rows = cleansing.dedup_latest(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], latest)
    return rows.select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey")


KEPT = "order_id, amount, status, order_ts"


@query(
    "dedup_then_filter",
    f"""WITH {roles.RAW_ORDERS}, {roles.TYPED},
        r AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {roles.LATEST}) AS rn FROM typed)
        SELECT {KEPT} FROM r WHERE rn = 1 AND status = 'completed'""",
)
def dedup_then_filter(spark, sf_dir):
    typed = cleansing.type_orders(roles.raw_orders(spark, sf_dir))
    rows = cleansing.dedup_then_filter(typed, ["order_id"], cleansing.latest_order_first(), F.col("status") == "completed")
    return rows.select(*KEPT.split(", "))


@query(
    "filter_then_dedup",
    f"""WITH {roles.RAW_ORDERS}, {roles.TYPED},
        r AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {roles.LATEST}) AS rn FROM typed
              WHERE status = 'completed')
        SELECT {KEPT} FROM r WHERE rn = 1""",
)
def filter_then_dedup(spark, sf_dir):
    typed = cleansing.type_orders(roles.raw_orders(spark, sf_dir))
    rows = cleansing.filter_then_dedup(typed, ["order_id"], cleansing.latest_order_first(), F.col("status") == "completed")
    return rows.select(*KEPT.split(", "))


@query(
    "referential_filter",
    f"""WITH {roles.RAW_ORDERS} SELECT order_id, customer_id, order_ts FROM raw_orders
        WHERE customer_id IN (SELECT c_custkey FROM customer)""",
)
def referential_filter(spark, sf_dir):
    rows = roles.raw_orders(spark, sf_dir).select("order_id", "customer_id", "order_ts")
    kept = cleansing.referential_filter(rows, table(spark, sf_dir, "customer"), "customer_id", "c_custkey")
    return kept.select("order_id", "customer_id", "order_ts")


def clean(spark, sf_dir):
    """Only the keys of customers and products matter here, so nothing else is read."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    return cleansing.clean_orders(roles.raw_orders(spark, sf_dir), customers, roles.products(spark, sf_dir))


CLEAN_COLUMNS = "order_id, customer_id, product_id, quantity, amount, status, order_ts"


@query("clean_orders", f"WITH {roles.CLEAN} SELECT {CLEAN_COLUMNS} FROM clean")
def clean_orders(spark, sf_dir):
    return clean(spark, sf_dir).select(*CLEAN_COLUMNS.split(", "))


@query(
    "standardize_orders",
    f"""WITH {roles.RAW_ORDERS}, {roles.TYPED},
        r AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {roles.LATEST}) AS rn FROM typed
              WHERE status <> 'cancelled' AND amount > 0)
        SELECT order_id, customer_id, amount, status, order_date FROM r WHERE rn = 1""",
)
def standardize_orders(spark, sf_dir):
    rows = cleansing.standardize_orders(roles.raw_orders(spark, sf_dir))
    return rows.select("order_id", "customer_id", "amount", "status", "order_date")


@query(
    "golden_record",
    rf"""WITH RECURSIVE rec AS (
           SELECT doc_id, source, lang, n_chars, trim(regexp_replace(lower(text), '[ \t\n\f\r]+', ' ', 'g')) AS norm,
                  NULLIF(lower(regexp_extract(text, '{C.EMAIL_PATTERN}', 0)), '') AS email FROM documents),
         mail AS (SELECT doc_id, lower(unnest(regexp_extract_all(text, '{C.EMAIL_PATTERN}'))) AS address FROM documents),
         ent AS (
           SELECT a.doc_id AS a, b.doc_id AS b FROM rec a JOIN rec b ON a.norm = b.norm
           UNION SELECT a.doc_id, b.doc_id FROM mail a JOIN mail b ON a.address = b.address),
         walk(a, b) AS (SELECT doc_id, doc_id FROM rec UNION SELECT w.a, e.b FROM walk w JOIN ent e ON w.b = e.a),
         lab AS (SELECT a AS doc_id, min(b) AS entity_id FROM walk GROUP BY a)
       SELECT entity_id, count(*) AS n_records, arg_max(email, (n_chars, rec.doc_id)) FILTER (email IS NOT NULL) AS email,
              arg_max(lang, (n_chars, rec.doc_id)) AS lang, arg_max(source, (n_chars, rec.doc_id)) AS source
       FROM rec JOIN lab ON rec.doc_id = lab.doc_id GROUP BY entity_id""",
)
def golden_record(spark, sf_dir):
    """Documents from several sources: same text or a common e-mail address means same entity."""
    norm = F.trim(F.regexp_replace(F.lower("text"), r"[ \t\n\f\r]+", " "))
    records = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", "n_chars", F.sha2(norm, 256).alias("digest"), C.emails("text").alias("emails")
    ).withColumn("email", F.get("emails", F.lit(0)))
    rules = {"text": F.col("digest"), "email": F.col("emails")}
    return entities.golden_record(records, "doc_id", rules, ["n_chars", "doc_id"], ["email", "lang", "source"])


NAMES = """letters AS (
    SELECT 10 * c_custkey + 1 AS id, c_custkey AS k, translate(md5(CAST(c_custkey AS VARCHAR)), '0123456789abcdef', 'abcdefghiklmnopr') AS w,
           c_nationkey AS nation, c_mktsegment AS segment, c_acctbal AS balance FROM customer
    UNION ALL SELECT 10 * s_suppkey + 3, s_suppkey, translate(md5('s' || s_suppkey), '0123456789abcdef', 'abcdefghiklmnopr'), s_nationkey, NULL, s_acctbal
    FROM supplier),
  named AS (SELECT id, k, 'the ' || substr(w, 1, 8) || ' ' || substr(w, 9, 6) || ' trading company' AS name, nation, segment, balance FROM letters),
  spoilt AS (
    SELECT id + 1 AS id, CASE k % 9 WHEN 0 THEN substr(name, 1, 5) || substr(name, 7) WHEN 3 THEN substr(name, 1, 6) || 'x' || substr(name, 8)
             ELSE substr(name, 1, 10) || 'q' || substr(name, 11) END AS name, k,
           CASE WHEN k % 15 <> 0 THEN nation END AS nation, CASE WHEN k % 21 = 0 THEN 'OTHER' ELSE segment END AS segment, balance
    FROM named WHERE k % 3 = 0),
  records AS (
    SELECT id, name, nation, segment, balance FROM named
    UNION ALL SELECT id, CASE WHEN k % 30 = 0 THEN substr(name, 1, length(name) - 1) WHEN k % 12 = 0 THEN upper(name) || '  ' ELSE name END,
      nation, segment, balance FROM spoilt)"""


@query(
    "golden_record_scored",
    f"""WITH RECURSIVE {NAMES},
          norm AS (SELECT *, trim(lower(name)) AS n FROM records),
          near AS (
            SELECT a.id AS a, b.id AS b FROM norm a JOIN norm b ON a.id <> b.id AND abs(length(a.n) - length(b.n)) <= 2
            WHERE levenshtein(a.n, b.n) <= 2 AND 0.7 * (1 - levenshtein(a.n, b.n) / CAST(greatest(length(a.n), length(b.n)) AS DOUBLE))
              + CASE WHEN a.nation = b.nation THEN 0.2 ELSE 0 END + CASE WHEN a.segment = b.segment THEN 0.1 ELSE 0 END >= 0.85 - 1e-9),
          walk(a, b) AS (SELECT id, id FROM norm UNION SELECT w.a, e.b FROM walk w JOIN near e ON w.b = e.a),
          lab AS (SELECT a AS id, min(b) AS entity_id FROM walk GROUP BY a)
        SELECT entity_id, count(*) AS n_records, arg_max(name, id) AS name, arg_max(nation, id) FILTER (nation IS NOT NULL) AS nation,
               arg_max(segment, id) FILTER (segment IS NOT NULL) AS segment, arg_max(balance, id) AS balance
        FROM norm JOIN lab USING (id) GROUP BY entity_id""",
)
def golden_record_scored(spark, sf_dir):
    """Customers and suppliers, and a second source that misspells a third of their names."""
    for name in ("customer", "supplier"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"names_{name}")
    sql = NAMES.replace("FROM customer", "FROM names_customer").replace("FROM supplier", "FROM names_supplier").replace("VARCHAR", "STRING")
    records = spark.sql(f"WITH {sql} SELECT * FROM records")
    fields = {"nation": (F.col("nation"), 0.2), "segment": (F.col("segment"), 0.1)}
    return similarity.golden_record_scored(
        records, "id", F.col("name"), fields, 0.7, 0.85, ["id"], ["name", "nation", "segment", "balance"]
    )


@query("build_dim_customer", f"WITH {roles.CUSTOMERS} SELECT customer_id, name, coalesce(region, 'Unknown') AS region FROM customers")
def build_dim_customer(spark, sf_dir):
    return dimensions.build_dim_customer(roles.customers(spark, sf_dir))


@query("build_dim_product", f"WITH {roles.PRODUCTS} SELECT * FROM products")
def build_dim_product(spark, sf_dir):
    return dimensions.build_dim_product(roles.products(spark, sf_dir))


@query(
    "date_dimension",
    f"""WITH {roles.CLEAN} SELECT DISTINCT order_date AS date_key, CAST(year(order_date) AS INTEGER) AS year,
        CAST(month(order_date) AS INTEGER) AS month, CAST(day(order_date) AS INTEGER) AS day FROM clean""",
)
def date_dimension(spark, sf_dir):
    return dimensions.build_dim_date(clean(spark, sf_dir))


@query(
    "build_fact_orders",
    f"WITH {roles.CLEAN} SELECT order_id, customer_id, product_id, order_date AS date_key, quantity, amount FROM clean",
)
def build_fact_orders(spark, sf_dir):
    return dimensions.build_fact_orders(clean(spark, sf_dir))


@query(
    "build_fact_enriched",
    f"""WITH {roles.RAW_ORDERS}, {roles.CUSTOMERS}
        SELECT order_id, customer_id, name AS customer_name, CAST(NULLIF(amount, '') AS DOUBLE) AS amount,
               lower(status) AS status, TRY_CAST(left(order_ts, 10) AS DATE) AS order_date
        FROM raw_orders JOIN customers USING (customer_id) WHERE CAST(NULLIF(amount, '') AS DOUBLE) > 0""",
)
def build_fact_enriched(spark, sf_dir):
    return dimensions.build_fact_enriched(roles.raw_orders(spark, sf_dir), roles.customers(spark, sf_dir))


@query(
    "snowflake_dimension",
    """SELECT p_partkey, p_brand, p_type FROM part""",
)
def snowflake_dimension(spark, sf_dir):
    """Brand and type move to a sub-dimension; joining it back gives the part again."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    sub, slim = dimensions.snowflake_dimension(parts, ["p_brand", "p_type"], "kind_sk")
    return slim.join(sub, "kind_sk").select("p_partkey", "p_brand", "p_type")
