"""Scalar, date, text, array, map and JSON functions, and user-defined functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions import collections as L
from millrace.functions import columns as C
from millrace.functions import udfs
from millrace.plans.registry import query, table
from millrace.session import scratch_name


@query(
    "date_parts_trunc",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
              CAST(date_trunc('year', o_orderdate) AS DATE) AS year_start FROM orders""",
)
def date_parts_trunc(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", day.alias("order_date"), F.trunc(day, "month").alias("month_start"), F.trunc(day, "year").alias("year_start")
    )


@query(
    "date_spine",
    """SELECT CAST(dt AS DATE) AS dt FROM generate_series((SELECT CAST(min(o_orderdate) AS DATE) FROM orders),
       (SELECT CAST(max(o_orderdate) AS DATE) FROM orders), INTERVAL 1 DAY) AS s(dt)""",
)
def date_spine(spark, sf_dir):
    """Calendar over the span of the orders; the span is one row, the calendar one row per day."""
    ends = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return ends.select(F.explode(F.sequence(F.to_date("a"), F.to_date("b"))).alias("dt"))


@query(
    "string_normalize",
    r"""SELECT page_id, lower(url) AS low, upper(url) AS up, trim(regexp_replace(lower(url), '\s+', ' ', 'g')) AS norm,
               string_split(url, '/')[3] AS host, CAST(len(regexp_split_to_array(url, '[/.]')) AS INTEGER) AS n_parts FROM pages""",
)
def string_normalize(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.lower("url").alias("low"),
        F.upper("url").alias("up"),
        C.normalize_text("url").alias("norm"),
        F.split("url", "/")[2].alias("host"),
        F.size(F.split("url", "[/.]")).alias("n_parts"),
    )


@query(
    "surrogate_key",
    "SELECT o_orderkey, sha256(o_orderkey || '||' || strftime(o_orderdate, '%Y-%m-%d')) AS sk FROM orders",
)
def surrogate_key(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", C.surrogate_key("o_orderkey", F.to_date("o_orderdate")).alias("sk"))


@query(
    "null_functions",
    """SELECT l_orderkey, l_linenumber, NULLIF(l_discount, 0) AS discount,
              coalesce(NULLIF(l_discount, 0), NULLIF(l_tax, 0), -1) AS rate FROM lineitem""",
)
def null_functions(spark, sf_dir):
    discount, tax = (F.nullif(F.col(c), F.lit(0.0)) for c in ("l_discount", "l_tax"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", discount.alias("discount"), F.coalesce(discount, tax, F.lit(-1.0)).alias("rate")
    )


@query(
    "round_money",
    """SELECT l_orderkey, CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - l_discount AS DECIMAL(5,2))), 2) AS DOUBLE)
       AS net FROM lineitem GROUP BY l_orderkey""",
)
def round_money(spark, sf_dir):
    net = C.money("l_extendedprice") * (1 - F.col("l_discount")).cast("decimal(5,2)")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.round(F.sum(net), 2).cast("double").alias("net"))


ITEMS = "array<struct<sku:bigint,qty:double>>"


def _payload(spark, sf_dir):
    """Each line as a JSON message with two items, its part and its supplier."""
    items = F.array(
        F.struct(F.col("l_partkey").alias("sku"), F.col("l_quantity").alias("qty")),
        F.struct(F.col("l_suppkey").alias("sku"), F.col("l_linenumber").cast("double").alias("qty")),
    )
    customer = F.struct(F.col("l_orderkey").alias("id"))
    body = F.struct(F.col("l_linenumber").alias("line"), customer.alias("customer"), items.alias("items"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.to_json(body).alias("payload"))


EXPLODED = """SELECT l_orderkey AS order_id, l_partkey AS sku, l_quantity AS qty FROM lineitem
              UNION ALL SELECT l_orderkey, l_suppkey, CAST(l_linenumber AS DOUBLE) FROM lineitem"""


@query("explode_items", EXPLODED)
def explode_items(spark, sf_dir):
    items = F.from_json("payload", f"items {ITEMS}")["items"]
    return L.explode_rows(_payload(spark, sf_dir), items, "i", "order_id").select("order_id", "i.sku", "i.qty")


@query("variant_flatten", EXPLODED)
def variant_flatten(spark, sf_dir):
    """The same messages as schema-less variants, flattened by a lateral table function."""
    name = scratch_name("payloads")
    _payload(spark, sf_dir).select("order_id", F.parse_json("payload").alias("v")).createOrReplaceTempView(name)
    return spark.sql(
        f"""SELECT order_id, variant_get(i.value, '$.sku', 'bigint') AS sku, variant_get(i.value, '$.qty', 'double') AS qty
            FROM {name}, LATERAL variant_explode(variant_get(v, '$.items')) AS i"""
    )


@query(
    "json_path_extract",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text,
              CAST(NULL AS VARCHAR) AS missing FROM events""",
)
def json_path_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.from_json("props", "k bigint")["k"].alias("k"),
        F.get_json_object("props", "$.k").alias("k_text"),
        F.try_variant_get(F.parse_json("props"), "$.nothing.here", "string").alias("missing"),
    )


@query(
    "array_hof",
    """SELECT vec_id, CAST(list_sum(list_transform(list_filter(embedding, lambda x: x > 0), lambda x: CAST(round(x * 1000) AS BIGINT))) AS BIGINT)
       AS total FROM embeddings""",
)
def array_hof(spark, sf_dir):
    total = L.map_filter_reduce(
        F.col("embedding"),
        lambda x: x > 0,
        lambda x: F.round(x * 1000).cast("long"),
        F.lit(0).cast("long"),
        lambda a, b: a + b,
    )
    return table(spark, sf_dir, "embeddings").select("vec_id", total.alias("total"))


@query(
    "array_flatten_nested",
    """SELECT page_id, array_to_string(flatten(list_transform(string_split(url, '/'), lambda x: string_split(x, '.'))), '|') AS parts FROM pages""",
)
def array_flatten_nested(spark, sf_dir):
    nested = F.transform(F.split("url", "/"), lambda x: F.split(x, r"\."))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(L.flatten_nested(nested), "|").alias("parts"))


@query(
    "array_set_ops",
    """SELECT page_id, CAST(len(list_distinct(a)) AS INTEGER) AS n_distinct, CAST(len(list_intersect(a, b)) AS INTEGER) AS n_common,
              len(list_filter(a, lambda x: NOT list_contains(b, x))) = 0 AS subset
       FROM (SELECT page_id, string_split(url, '/') AS a, string_split(replace(url, '.', '/'), '/') AS b FROM pages)""",
)
def array_set_ops(spark, sf_dir):
    a, b = F.split("url", "/"), F.split(F.replace("url", F.lit("."), F.lit("/")), "/")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.size(L.ordered_distinct(a)).alias("n_distinct"),
        F.size(L.common_elements(a, b)).alias("n_common"),
        L.is_subset(a, b).alias("subset"),
    )


@query(
    "map_build_invert",
    """SELECT o_orderkey, o_custkey AS by_name, CASE WHEN o_custkey = o_orderkey THEN 'cust' ELSE 'order' END AS name_of_order,
              CAST(CASE WHEN o_custkey = o_orderkey THEN 1 ELSE 2 END AS INTEGER) AS n_inverted FROM orders""",
)
def map_build_invert(spark, sf_dir):
    built = L.map_of(F.array(F.lit("order"), F.lit("cust")), F.array(F.col("o_orderkey"), F.col("o_custkey")))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", built.alias("m")).withColumn("inv", L.invert_map(F.col("m")))
    return rows.select(
        "o_orderkey",
        F.element_at("m", "cust").alias("by_name"),
        F.try_element_at("inv", F.col("o_orderkey")).alias("name_of_order"),
        F.size("inv").alias("n_inverted"),
    )


BUCKET = "SELECT event_id, CASE WHEN value * 10 >= 1000 THEN 'high' ELSE 'low' END AS bucket FROM events"


@query("udf_bucket", BUCKET)
def udf_bucket(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", udfs.bucket_udf()(F.col("value") * 10).alias("bucket"))


@query("pandas_udf_bucket", BUCKET)
def pandas_udf_bucket(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", udfs.bucket_pandas_udf()(F.col("value") * 10).alias("bucket"))


@query("sql_udf", "SELECT o_orderkey, CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DOUBLE) / 100 AS price FROM orders")
def sql_udf(spark, sf_dir):
    udfs.register_sql_function(spark, "cents_to_units", "cents BIGINT", "DECIMAL(18,2)", "CAST(cents / 100.0 AS DECIMAL(18,2))")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    priced = F.call_function("cents_to_units", cents).cast("double")
    return table(spark, sf_dir, "orders").select("o_orderkey", priced.alias("price"))


@query("partition_function", "SELECT event_id, upper(event_type) AS label FROM events")
def partition_function(spark, sf_dir):
    """A lookup built once per partition instead of once per row."""

    def connect() -> dict[str, str]:
        return {t: t.upper() for t in ("click", "error", "purchase", "signup", "view")}

    def label(lookup: dict[str, str], batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"event_id": batch["event_id"], "label": batch["event_type"].map(lookup)})

    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    return udfs.map_partitions(rows, connect, label, "event_id bigint, label string")
