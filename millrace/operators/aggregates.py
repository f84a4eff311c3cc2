"""Grouped reports. All use combinable aggregates, so rows are reduced before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.collections import explode_rows
from millrace.functions.columns import as_column, money, money_total
from millrace.operators.joins import null_safe_join
from millrace.operators.skew import MAX_PIECES, MIN_PIECE_ROWS, OrderedSplit


def summarize(df: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """Row count, rounded total and average per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(money(amount)), 2).cast("double").alias("total"),
        F.round(F.sum(money(amount)) / F.count(amount), 2).cast("double").alias("average"),
    )


def min_max_total(df: DataFrame, amount: str) -> DataFrame:
    return df.agg(
        F.min(amount).alias("lowest"),
        F.max(amount).alias("highest"),
        money_total(amount).alias("total"),
        F.count(F.lit(1)).alias("n"),
    )


def rows_and_distinct(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(key).alias("distinct_keys"))


def keys_with_more_than(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit)


def pivot_sum(df: DataFrame, keys: Sequence[str], pivot: str, values: Mapping[object, str], amount: str) -> DataFrame:
    """One column per listed value, zero where the key has none of it."""
    return df.groupBy(*keys).agg(
        *[
            F.sum(F.when(F.col(pivot) == v, money(amount)).otherwise(F.lit(0).cast("decimal(18,2)")))
            .cast("double")
            .alias(name)
            for v, name in values.items()
        ]
    )


def revenue_by(facts: DataFrame, dimension: DataFrame, on: str, group: str, amount: str = "amount") -> DataFrame:
    """Revenue and number of orders per dimension attribute.

    Facts are added up per dimension key before the join, so the join input has
    one row per key and a frequent key costs no more than a rare one.
    """
    per_key = facts.groupBy(on).agg(F.sum(money(amount)).alias("_r"), F.count(F.lit(1)).alias("_n"))
    return (
        per_key.join(dimension.select(on, group), on)
        .groupBy(group)
        .agg(F.sum("_r").cast("double").alias("revenue"), F.sum("_n").alias("orders"))
    )


def top_products(facts: DataFrame, products: DataFrame, n: int) -> DataFrame:
    """Best sellers by revenue; grouped by id, since names repeat."""
    per_key = facts.groupBy("product_id").agg(
        F.sum(money("amount")).alias("_r"), F.sum("quantity").cast("double").alias("units")
    )
    named = per_key.join(products.select("product_id", "product_name", "category"), "product_id")
    best = named.orderBy(F.desc("_r"), F.asc("product_id")).limit(n)
    return best.select("product_id", "product_name", "category", F.col("_r").cast("double").alias("revenue"), "units")


def daily_revenue(facts: DataFrame, date_column: str = "order_date", amount: str = "amount") -> DataFrame:
    return facts.groupBy(date_column).agg(money_total(amount).alias("revenue"))


def revenue_last_month(df: DataFrame, group: str, ts: str, amount: str, as_of: str) -> DataFrame:
    """Revenue per group in the calendar month before ``as_of``; the bounds are
    constants compared with the bare column, so they reach the scan."""
    this_month = F.trunc(F.lit(as_of).cast("date"), "month")
    low = F.add_months(this_month, -1).cast("timestamp_ntz")
    high = this_month.cast("timestamp_ntz")
    return df.filter((F.col(ts) >= low) & (F.col(ts) < high)).groupBy(group).agg(money_total(amount).alias("revenue"))


def arg_max(df: DataFrame, key: str, value: Column, descending_tie: bool = False) -> DataFrame:
    """The key that holds the largest value; the smallest such key on a tie."""
    best = df.select(F.col(key).alias(key), as_column(value).alias("value"))
    return best.orderBy(F.desc("value"), F.desc(key) if descending_tie else F.asc(key)).limit(1)


def customer_features(orders: DataFrame, customer: str, ts: str, amount: str, as_of: str) -> DataFrame:
    """Recency in days, frequency and monetary totals per customer."""
    return orders.groupBy(customer).agg(
        F.date_diff(F.lit(as_of).cast("date"), F.max(ts).cast("date")).cast("long").alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        money_total(amount).alias("monetary"),
        F.max(amount).alias("largest"),
        F.count_if(F.col(ts) >= F.lit(as_of).cast("timestamp_ntz") - F.expr("INTERVAL 365 DAY")).alias("orders_last_year"),
    )


def word_count(df: DataFrame, text: str, pattern: str = r"\s+") -> DataFrame:
    words = explode_rows(df, F.split(text, pattern), "word")
    return words.filter("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def most_common(df: DataFrame, column: str, k: int) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(k)


def group_collect(
    df: DataFrame,
    key: str,
    value: str,
    list_length: int,
    min_piece_rows: int = MIN_PIECE_ROWS,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """Sorted values per key, repeats kept, in numbered lists of at most ``list_length``.

    A key with few values gives one list; a key with millions gives several, so
    that no single row has to hold an unbounded group. Nothing is cut off.
    """
    # Equal values change places freely; the row number lets a value that repeats very often be cut too.
    pairs = df.select(key, value).withColumn("_row", F.monotonically_increasing_id())
    split = OrderedSplit(pairs, [key], [value, "_row"], min_piece_rows, max_pieces)
    numbered = split.done(split.row_number(split.df, "_n"))
    part = F.floor((F.col("_n") - 1) / list_length).cast("long")
    return (
        numbered.withColumn("list_no", part)
        .groupBy(key, "list_no")
        .agg(F.sort_array(F.collect_list(value)).alias("values"))
    )


def refresh_aggregate(
    current: DataFrame,
    facts: DataFrame,
    changed: DataFrame,
    keys: Sequence[str],
    aggregates: Mapping[str, Column],
) -> DataFrame:
    """Maintained aggregate after ``changed`` rows arrived in ``facts``.

    Only groups that occur in ``changed`` are computed again; every other group
    is taken over. Pass all facts, the changed rows included.
    """
    touched = changed.select(*keys).distinct()
    fresh = null_safe_join(facts, touched, keys, "left_semi").groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return null_safe_join(current, touched, keys, "left_anti").unionByName(fresh)
