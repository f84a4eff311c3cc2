"""Star-schema builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import group_key, or_unknown, text_to_number
from millrace.operators.joins import join_point_in_time

UNKNOWN_KEY = "unknown"


def build_dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "name", or_unknown("region").alias("region"))


def build_dim_product(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_name", "category", "unit_price")


def build_dim_date(facts: DataFrame, date_column: str = "order_date") -> DataFrame:
    days = facts.select(F.col(date_column).alias("date_key")).distinct()
    return days.select(
        "date_key",
        F.year("date_key").alias("year"),
        F.month("date_key").alias("month"),
        F.dayofmonth("date_key").alias("day"),
    )


def build_fact_orders(clean: DataFrame) -> DataFrame:
    """Grain: one completed order."""
    return clean.select("order_id", "customer_id", "product_id", F.col("order_date").alias("date_key"), "quantity", "amount")


def build_fact_enriched(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Staged orders (typed amount, lower-case status, positive only) with the customer name."""
    staged = orders.select(
        "order_id",
        "customer_id",
        text_to_number("amount", "decimal(18,2)").alias("amount"),
        F.lower("status").alias("status"),
        F.try_to_timestamp("order_ts").alias("order_ts"),
    ).filter("amount > 0")
    names = customers.select("customer_id", F.col("name").alias("customer_name"))
    return staged.join(names, "customer_id").select(
        "order_id", "customer_id", "customer_name", F.col("amount").cast("double").alias("amount"), "status",
        F.to_date("order_ts").alias("order_date"),
    )


def fact_surrogate_lookup(
    facts: DataFrame, dim: DataFrame, key: str, at: str, sk: str, unique: str, **options: object
) -> DataFrame:
    """Replace the natural key by the surrogate key of the version valid at ``at``."""
    versions = dim.select(key, "start_date", "end_date", sk)
    found = join_point_in_time(facts, versions, key, at, unique=unique, how="left", **options)
    return found.withColumn(sk, F.coalesce(sk, F.lit(UNKNOWN_KEY))).drop(key, "start_date", "end_date")


def snowflake_dimension(
    dim: DataFrame, attributes: Sequence[str], sk: str, parts: Sequence[Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Move an attribute group to its own table; the dimension keeps the key. NULL is an
    attribute value of its own."""
    key = group_key(*(parts or attributes))
    sub = dim.select(key.alias(sk), *attributes).distinct()
    return sub, dim.withColumn(sk, key).drop(*attributes)
