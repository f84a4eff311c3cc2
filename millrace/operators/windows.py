"""Ranking, running and gap calculations per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import as_column, money
from millrace.operators.joins import null_safe_join
from millrace.operators.skew import MAX_PIECES, MIN_PIECE_ROWS, OrderedSplit


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str = "rn") -> DataFrame:
    """First ``n`` rows per key. Spark prunes each map task to ``n`` rows per key
    before the shuffle (WindowGroupLimit), which also tames frequent keys."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n).withColumn(name, F.col(name).cast("long"))


def nth_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """Exactly one row per key: the n-th, if there is one."""
    return top_n_per_group(df, keys, order, n, "_rn").filter(F.col("_rn") == n).drop("_rn")


def nth_distinct_value(df: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """All rows that hold the n-th highest distinct value of their key.

    Distinct values are ranked first, so ties never enlarge a window.
    """
    values = df.select(*keys, value).filter(F.col(value).isNotNull()).distinct()
    nth = nth_row(values, keys, [F.desc(value)], n)
    return null_safe_join(df, nth, [*keys, value], "left_semi")


def top_n_after_aggregate(
    df: DataFrame, group: Sequence[str], item: Sequence[str], total: Column, n: int, name: str = "total"
) -> DataFrame:
    """Rank items inside a group by an aggregate and keep the first ``n``."""
    sums = df.groupBy(*group, *item).agg(total.alias(name))
    return top_n_per_group(sums, group, [F.desc(name), *[F.asc(i) for i in item]], n)


def rank_with_gaps(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str = "rnk",
    min_piece_rows: int = MIN_PIECE_ROWS,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """RANK by ``value`` descending with NULLs last: one more than the number of larger values.

    Counts per distinct value are added up and joined back; equal values are
    one counted row, and AQE can split the join for a very frequent value.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    split = OrderedSplit(counts, keys, [value], min_piece_rows, max_pieces, weigh=df)
    upto = split.done(split.running_sum(split.df, {"_upto": "_n"}))
    totals = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"))
    ranks = null_safe_join(upto, totals, keys, "inner")
    ranks = ranks.select(*keys, value, (F.col("_all") - F.col("_upto") + 1).alias(name))
    return null_safe_join(df, ranks, [*keys, value], "inner")


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str = "running_total",
    min_piece_rows: int = MIN_PIECE_ROWS,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    split = OrderedSplit(df, keys, order, min_piece_rows, max_pieces)
    return split.done(split.running_sum(split.df, {name: money(value)})).withColumn(name, F.col(name).cast("double"))


def lag_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, str],
    min_piece_rows: int = MIN_PIECE_ROWS,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    split = OrderedSplit(df, keys, order, min_piece_rows, max_pieces)
    return split.done(split.previous(split.df, columns))


def lead_next(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, str],
    min_piece_rows: int = MIN_PIECE_ROWS,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    split = OrderedSplit(df, keys, order, min_piece_rows, max_pieces)
    return split.done(split.following(split.df, columns))


def growth_by_month(df: DataFrame, ts: str, amount: str) -> DataFrame:
    """Revenue per month, the month before, and growth in percent with one decimal.

    The window without a key sees one row per month only.
    """
    months = df.groupBy(F.trunc(F.col(ts).cast("date"), "month").alias("mth")).agg(F.sum(money(amount)).alias("_rev"))
    prev = F.lag("_rev").over(Window.orderBy("mth"))
    growth = F.round(F.lit(100) * (F.col("_rev") - F.col("_prev")) / F.nullif(F.col("_prev"), F.lit(0)), 1)
    return months.withColumn("_prev", prev).select(
        "mth",
        F.col("_rev").cast("double").alias("rev"),
        F.col("_prev").cast("double").alias("prev"),
        growth.cast("double").alias("growth_pct"),
    )


def streaks(df: DataFrame, key: str, day: str | Column) -> DataFrame:
    """Runs of consecutive days per key: first day, last day, length.

    Days are made distinct before the window, so a partition holds at most one
    row per calendar day.
    """
    days = df.select(key, as_column(day).alias("_d")).distinct()
    position = F.row_number().over(Window.partitionBy(key).orderBy("_d"))
    return (
        days.withColumn("_island", F.date_sub("_d", position))
        .groupBy(key, "_island")
        .agg(
            F.min("_d").alias("start_date"),
            F.max("_d").alias("end_date"),
            F.count(F.lit(1)).alias("streak_len"),
        )
        .drop("_island")
    )


def sessionize(
    df: DataFrame,
    key: str,
    ts: str,
    unique: str,
    gap: str = "30 minutes",
    name: str = "session_no",
    min_piece_rows: int = MIN_PIECE_ROWS,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """Number the sessions of a key; a pause longer than ``gap`` starts the next one."""
    split = OrderedSplit(df, [key], [ts, unique], min_piece_rows, max_pieces)
    rows = split.previous(split.df, {"_before": ts})
    starts = F.col("_before").isNull() | (F.col(ts) - F.col("_before") > F.expr(f"INTERVAL {gap}"))
    rows = rows.withColumn("_starts", F.when(starts, 1).otherwise(0).cast("long"))
    return split.done(split.running_sum(rows, {name: "_starts"})).drop("_before", "_starts")
