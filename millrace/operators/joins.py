"""Join operators beyond the plain ``DataFrame.join``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import MAX_PIECES, MIN_PIECE_ROWS, OrderedSplit, salted_join

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
OPEN_END = "9999-12-31"


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for the optimized plan."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast hint only when the estimate is below the limit; otherwise the
    plan is left to Spark, which shuffles both sides and splits skewed parts."""
    return F.broadcast(df) if estimated_bytes(df) <= limit_bytes else df


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys, NULL equal to NULL; the keys of ``right`` are not repeated."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(other, same, how).drop(*[f"_r_{k}" for k in keys])


def join_broadcast(
    big: DataFrame,
    small: DataFrame,
    on: str | list[str] | Column,
    how: str = "inner",
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    return big.join(broadcast_if_small(small, limit_bytes), on, how)


def join_salted(big: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner", **limits: int) -> DataFrame:
    return salted_join(big, other, keys, how, **limits)


def rows_with_match(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``.

    Spark cannot split the right side of a semi or anti join, so its keys are
    made distinct first; copies disappear before the shuffle.
    """
    return df.join(other.select(*on).distinct(), list(on), "left_semi").select(*df.columns)


def rows_without_match(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``."""
    return df.join(other.select(*on).distinct(), list(on), "left_anti").select(*df.columns)


def join_full(big: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join whose ``big`` side may hold heavy keys.

    Spark cannot split a skewed full join. A left join it can, and what that
    leaves out are the rows of ``other`` whose key is not in ``big``.
    """
    matched = big.join(other, list(on), "left")
    return matched.unionByName(rows_without_match(other, big, on), allowMissingColumns=True)


def date_spine(df: DataFrame, first: str, last: str, name: str = "dt") -> DataFrame:
    """One row per day between two dates, both included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return df.sparkSession.range(1).select(F.explode(days).alias(name))


def missing_dates(df: DataFrame, date_column: str, first: str, last: str) -> DataFrame:
    """Calendar days in the range on which ``df`` has no row."""
    present = df.select(F.col(date_column).alias("dt")).distinct()
    return date_spine(df, first, last).join(present, "dt", "left_anti")


def join_point_in_time(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    start: str = "start_date",
    end: str = "end_date",
    unique: str | None = None,
    how: str = "inner",
    min_piece_rows: int = MIN_PIECE_ROWS,
    max_pieces: int = MAX_PIECES,
    weigh_versions: DataFrame | None = None,
) -> DataFrame:
    """Each fact with the version of its key valid at ``at``: ``start <= at < end``,
    an absent end meaning still open.

    The versions of one key must not overlap. Facts and versions of a key are
    laid on one time line and each fact takes the last version before it, so
    the work is linear in both inputs where a range join would compare every
    fact with every version of the key. ``unique`` names the fact column that
    makes ``(key, at)`` a total order; without it, facts of equal time are
    interchangeable. ``weigh_versions`` may give the keys and starts of the
    versions more cheaply when ``versions`` is itself a long computation.
    """
    carried = [c for c in versions.columns if c != key]
    clash = set(carried) & set(facts.columns)
    if clash:
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    tie = F.col(unique).cast("string") if unique else F.xxhash64(*facts.columns).cast("string")
    ends = F.coalesce(F.col(end).cast("timestamp_ntz"), F.lit(OPEN_END).cast("timestamp_ntz"))
    # At equal time a version precedes the facts, and an empty version precedes its successor.
    starts = F.col(start).cast("timestamp_ntz").alias("_t")
    # As in a range join, a version without key or start matches nothing.
    usable = F.col(key).isNotNull() & F.col(start).isNotNull()
    version_rows = versions.filter(usable).select(
        key, starts, F.lit(0).alias("_kind"), ends.cast("string").alias("_tie"), F.struct(ends.alias("_ends"), F.struct(*carried).alias("_version")).alias("_cand")
    )
    fact_rows = facts.select(
        key,
        F.col(at).cast("timestamp_ntz").alias("_t"),
        F.lit(1).alias("_kind"),
        tie.alias("_tie"),
        F.struct(*[c for c in facts.columns if c != key]).alias("_fact"),
    )
    line = version_rows.unionByName(fact_rows, allowMissingColumns=True)
    order = ["_t", "_kind", "_tie"]
    weights = fact_rows.select(key, *order).unionByName(
        version_rows.select(key, *order)
        if weigh_versions is None
        else weigh_versions.filter(usable).select(key, starts, F.lit(0).alias("_kind"), F.lit("").alias("_tie"))
    )
    split = OrderedSplit(line, [key], order, min_piece_rows, max_pieces, weigh=weights)
    seen = split.last_known(split.df, "_last", "_cand").filter("_kind = 1")
    valid = F.when(F.col("_last._ends") > F.col("_t"), F.col("_last._version"))
    found = seen.withColumn("_valid", valid)
    if how == "inner":
        found = found.filter(F.col("_valid").isNotNull())
    elif how != "left":
        raise ValueError("join_point_in_time supports inner and left joins")
    return found.select(key, "_fact.*", *[F.col(f"_valid.{c}").alias(c) for c in carried])


def newer_than_target(source: DataFrame, target: DataFrame, column: str, inclusive: bool = False) -> DataFrame:
    """Rows beyond the highest value of ``target``; an empty target lets all rows through.

    The highest value is fetched first, so that the filter compares with a constant:
    it reaches the scan and prunes files and partitions of the source.
    """
    high = target.agg(F.max(column).cast("string")).first()[0]
    if high is None:
        return source
    mark = F.lit(high).cast(source.schema[column].dataType)
    return source.filter(F.col(column) >= mark if inclusive else F.col(column) > mark)
