"""Slowly changing dimensions and snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import any_differs, surrogate_key
from millrace.operators.cleansing import dedup_latest
from millrace.operators.joins import BROADCAST_LIMIT_BYTES, broadcast_if_small, estimated_bytes
from millrace.operators.skew import MAX_PIECES, MIN_PIECE_ROWS, OrderedSplit

START, END, CURRENT = "start_date", "end_date", "is_current"
HISTORY_COLUMNS = (START, END, CURRENT)


def scd1_validate(dim: DataFrame, key: str) -> DataFrame:
    """One row per key holds if both counts are equal."""
    counts = dim.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(key).alias("distinct_keys"))
    return counts.withColumn("valid", F.col("total_rows") == F.col("distinct_keys"))


def scd2_init(df: DataFrame, key: str, effective: str | Column, sk: str) -> DataFrame:
    start = (F.lit(effective) if isinstance(effective, str) else effective).cast("date")
    return df.withColumns(
        {
            START: start,
            END: F.lit(None).cast("date"),
            CURRENT: F.lit(True),
            sk: surrogate_key(key, start),
        }
    )


def _batch(batch: DataFrame, key: str, effective: str) -> DataFrame:
    others = [F.desc(c) for c in batch.columns if c not in (key, effective)]
    return dedup_latest(batch, [key], [F.desc(effective), *others])


def scd2_detect_changed(
    dim: DataFrame, batch: DataFrame, key: str, tracked: Sequence[str], effective: str = "effective_date"
) -> DataFrame:
    """Batch rows whose key has a current version that differs in a tracked column."""
    now = dim.filter(CURRENT).select(key, F.struct(*tracked).alias("_now"))
    pairs = _batch(batch, key, effective).join(now, key)
    differs = any_differs([F.col(c) for c in tracked], [F.col(f"_now.{c}") for c in tracked])
    return pairs.filter(differs).select(*batch.columns)


def _not_before(start: Column, effective: Column) -> Column:
    """The date on which a version ends. A batch dated before the version began is an error:
    the version would end before it starts."""
    told = F.concat(F.lit("batch dated "), effective.cast("string"), F.lit(" is older than a current version of "), start.cast("string"))
    return F.when(effective.cast("timestamp") < start.cast("timestamp"), F.raise_error(told)).otherwise(effective)


def scd2_merge(
    dim: DataFrame,
    batch: DataFrame,
    key: str,
    tracked: Sequence[str],
    sk: str,
    effective: str = "effective_date",
) -> DataFrame:
    """Dimension after the batch: changed keys get their version closed and a new one opened.

    Current rows meet the batch in one full join, and each pair yields the one
    or two rows it stands for. Closed versions are passed through unshuffled.
    """
    attributes = [c for c in dim.columns if c not in (key, sk, *HISTORY_COLUMNS)]
    types = {f.name: f.dataType for f in dim.schema.fields}
    current = F.coalesce(F.col(CURRENT), F.lit(False))
    old = dim.filter(current).select(F.col(key), F.struct(*dim.columns).alias("_old"))
    new = _batch(batch, key, effective).select(F.col(key), F.struct(*attributes, effective).alias("_new"))
    both = old.join(new, key, "full")

    def row(values: dict[str, Column]) -> Column:
        return F.struct(*[values[c].cast(types[c]).alias(c) for c in dim.columns])

    kept = {c: F.col(f"_old.{c}") for c in dim.columns}
    closed = {**kept, END: _not_before(F.col(f"_old.{START}"), F.col(f"_new.{effective}")), CURRENT: F.lit(False)}
    opened = {
        key: F.col(key),
        **{c: F.col(f"_new.{c}") for c in attributes},
        START: F.col(f"_new.{effective}"),
        END: F.lit(None),
        CURRENT: F.lit(True),
        sk: surrogate_key(key, f"_new.{effective}"),
    }
    differs = any_differs([F.col(f"_old.{c}") for c in tracked], [F.col(f"_new.{c}") for c in tracked])
    rows = (
        F.when(F.col("_old").isNull(), F.array(row(opened)))
        .when(F.col("_new").isNull() | ~differs, F.array(row(kept)))
        .otherwise(F.array(row(closed), row(opened)))
    )
    return both.select(F.inline(rows)).unionByName(dim.filter(~current))


def scd2_two_step(
    dim: DataFrame,
    batch: DataFrame,
    key: str,
    tracked: Sequence[str],
    sk: str,
    effective: str = "effective_date",
) -> DataFrame:
    """Same result in two steps: close changed rows, then insert keys without a current row.

    Suits a batch that is small beside the dimension: the dimension is probed
    with the broadcast batch, and only keys found in both go on, so the
    dimension itself is never shuffled.
    """
    source = _batch(batch, key, effective)
    # One decision for all three joins: what meets the dimension is no larger than the batch.
    small = F.broadcast if estimated_bytes(source) <= BROADCAST_LIMIT_BYTES else lambda df: df
    probe = small(source.select(key, F.struct(*tracked).alias("_new"), F.col(effective).alias("_gone")))
    met = dim.filter(CURRENT).join(probe, key)
    differs = any_differs([F.col(c) for c in tracked], [F.col(f"_new.{c}") for c in tracked])
    met = met.select(key, "_gone", differs.alias("_differs")).dropDuplicates([key])
    expired = _close(dim, small(met.filter("_differs").select(key, "_gone")), key)
    missing = source.join(small(met.filter("NOT _differs").select(key)), key, "left_anti")
    attributes = [c for c in dim.columns if c not in (key, sk, *HISTORY_COLUMNS)]
    opened = scd2_init(missing.select(key, *attributes, effective), key, F.col(effective), sk)
    return expired.unionByName(opened.drop(effective))


def scd2_soft_delete(dim: DataFrame, deleted: DataFrame, key: str, deleted_on: str) -> DataFrame:
    """Close the current version of every key in ``deleted``; history stays."""
    gone = deleted.groupBy(key).agg(F.min(deleted_on).cast("date").alias("_gone"))
    return _close(dim, broadcast_if_small(gone), key)


def _close(dim: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    close = F.col(CURRENT) & F.col("_gone").isNotNull()
    return (
        dim.join(gone, key, "left")
        .withColumns(
            {
                END: F.when(close, _not_before(F.col(START), F.col("_gone"))).otherwise(F.col(END)),
                CURRENT: F.when(close, F.lit(False)).otherwise(F.col(CURRENT)),
            }
        )
        .select(*dim.columns)
    )


def scd2_current(dim: DataFrame) -> DataFrame:
    return dim.filter(CURRENT)


def scd2_history(dim: DataFrame, key: str, value: object) -> DataFrame:
    return dim.filter(F.col(key) == F.lit(value))


def scd2_versions(dim: DataFrame, key: str) -> DataFrame:
    return dim.groupBy(key).agg(F.count(F.lit(1)).alias("versions"))


def scd2_as_of(dim: DataFrame, day: str) -> DataFrame:
    """Versions valid on ``day``: started by then and not yet ended."""
    at = F.lit(day).cast("date")
    return dim.filter((F.col(START) <= at) & (F.col(END).isNull() | (F.col(END) > at)))


def scd2_integrity(dim: DataFrame, key: str) -> DataFrame:
    """Counts that must be zero, plus the number of keys with several versions."""
    per_key = dim.groupBy(key).agg(
        F.count_if(CURRENT).alias("_current"),
        F.count(F.lit(1)).alias("_versions"),
        F.count_if((F.col(CURRENT) == F.col(END).isNotNull()) | F.coalesce(F.col(END) < F.col(START), F.lit(False))).alias("_bad_end"),
    )
    return per_key.agg(
        F.count_if(F.col("_current") > 1).alias("keys_with_two_current"),
        F.sum("_bad_end").alias("bad_end_date"),
        F.count_if(F.col("_versions") > 1).alias("keys_with_history"),
        F.sum("_versions").alias("total_versions"),
    )


def scd3_previous_value(dim: DataFrame, batch: DataFrame, key: str, column: str) -> DataFrame:
    """Keep the value before the last change in ``prev_<column>``."""
    previous = f"prev_{column}"
    if previous not in dim.columns:
        dim = dim.withColumn(previous, F.lit(None).cast(dim.schema[column].dataType))
    new = dedup_latest(batch.select(key, F.col(column).alias("_new"), F.lit(True).alias("_hit")), [key], [F.desc("_new")])
    changed = F.coalesce(F.col("_hit"), F.lit(False)) & ~F.col(column).eqNullSafe(F.col("_new"))
    return (
        dim.join(new, key, "left")
        .withColumns(
            {
                previous: F.when(changed, F.col(column)).otherwise(F.col(previous)),
                column: F.when(changed, F.col("_new")).otherwise(F.col(column)),
            }
        )
        .drop("_new", "_hit")
    )


def snapshot_check(
    loads: DataFrame,
    key: str,
    loaded_at: str,
    columns: Sequence[str],
    min_piece_rows: int = MIN_PIECE_ROWS,
    max_pieces: int = MAX_PIECES,
    weigh: DataFrame | None = None,
) -> DataFrame:
    """History from repeated loads: a version starts when a compared column changes.

    ``loads`` holds at most one row per key and load. Returns the compared
    columns with ``valid_from`` and ``valid_to`` (NULL while still valid).
    """
    split = OrderedSplit(loads.select(key, loaded_at, *columns), [key], [loaded_at], min_piece_rows, max_pieces, weigh)
    before = {f"_b_{c}": c for c in columns}
    rows = split.previous(split.df, {"_b_at": loaded_at, **before})
    differs = any_differs([F.col(c) for c in columns], [F.col(b) for b in before])
    starts = rows.filter(F.col("_b_at").isNull() | differs).drop("_b_at", *before)
    closed = split.done(split.following(starts, {"valid_to": loaded_at}))
    return closed.withColumnRenamed(loaded_at, "valid_from")


def snapshot_timestamp(
    loads: DataFrame,
    key: str,
    updated_at: str,
    unique: str,
    columns: Sequence[str],
    min_piece_rows: int = MIN_PIECE_ROWS,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """History by a change time: every new ``updated_at`` of a key is a version.

    If a key carries one time twice, the row with the highest ``unique`` stays.
    """
    rows = dedup_latest(loads.select(key, updated_at, unique, *columns), [key, updated_at], [F.desc(unique)])
    split = OrderedSplit(rows.drop(unique), [key], [updated_at], min_piece_rows, max_pieces, weigh=loads)
    closed = split.done(split.following(split.df, {"valid_to": updated_at}))
    return closed.withColumnRenamed(updated_at, "valid_from")
