"""Row-level changes on plain columnar tables.

Each operator returns the table after the change; :mod:`millrace.sources.writers`
publishes it. A repeated source key would make a merge ambiguous, so the source
is reduced to its latest row per key first. A NULL in a key equals a NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.cleansing import dedup_latest
from millrace.operators.joins import BROADCAST_LIMIT_BYTES, estimated_bytes

#: Keys of a batch that are sent to every task, at most.
BROADCAST_KEYS = 500_000


def _same_key(keys: Sequence[str]) -> Column:
    """Rows of ``t`` and ``s`` have the same key."""
    return reduce(and_, [F.col(f"t.`{k}`").eqNullSafe(F.col(f"s.`{k}`")) for k in keys])


def _one_per_key(source: DataFrame, keys: Sequence[str], latest: Sequence[Column] | None) -> DataFrame:
    """Without an order, equal rows are one row and different rows of one key are an error:
    the least and the greatest row of each key, from one aggregate, tell them apart."""
    if latest is not None:
        return dedup_latest(source, keys, latest)
    others = [c for c in source.columns if c not in keys]
    if not others:
        return source.distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    ends = source.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.struct(F.min(row).alias("low"), F.max(row).alias("high")).alias("_ends"))
    told = F.concat_ws(", ", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("NULL")) for k in keys])
    fault = F.raise_error(F.concat(F.lit("several source rows for key "), told, F.lit("; say which is the latest")))
    one = ends.filter(F.when(F.col("_ends.low").eqNullSafe(F.col("_ends.high")), True).otherwise(fault.cast("boolean")))
    return one.select(*[F.col(f"`{k}`") for k in keys], "_ends.low.*").select(*[F.col(f"`{c}`") for c in source.columns])


def _without_keys_of(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    replaced = source.select(*keys).distinct()
    if estimated_bytes(replaced) <= BROADCAST_LIMIT_BYTES:
        # The estimate is of bytes in files; keys take many times as much in memory, so they are counted.
        few = replaced.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
        replaced = F.broadcast(replaced) if few else replaced.hint("merge")
    return target.alias("t").join(replaced.alias("s"), _same_key(keys), "left_anti").select(*target.columns)


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], latest: Sequence[Column] | None = None
) -> DataFrame:
    """Source rows replace target rows of the same key; new keys are added.

    The keys of a batch that is estimated small, and is by a count of them, are
    broadcast, so that it does not shuffle a large target.
    """
    rows = _one_per_key(source, keys, latest).select(*target.columns)
    return _without_keys_of(target, source, keys).unionByName(rows)


def staging_delete_insert(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the keys present in staging, then insert all staging rows."""
    return _without_keys_of(target, staging, keys).unionByName(staging.select(*target.columns))


def merge_with_delete(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    op: str = "_op",
    latest: Sequence[Column] | None = None,
) -> DataFrame:
    """Matched and ``D``: delete; matched: set the ``update`` columns; otherwise insert.

    A delete for a key the target does not have is ignored. Inserted rows take
    every target column from the source.
    """
    rows = _one_per_key(source, keys, latest)
    others = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(*others).alias("_t"))
    new = rows.select(*keys, F.struct(op, *others).alias("_s"))
    merged = old.alias("t").join(new.alias("s"), _same_key(keys), "full").filter(~F.coalesce(F.col(f"_s.{op}") == "D", F.lit(False)))
    inserted, untouched = F.col("_t").isNull(), F.col("_s").isNull()
    picked = [
        F.when(inserted, F.col(f"_s.{c}")).when(untouched, F.col(f"_t.{c}")).otherwise(
            F.col(f"_s.{c}" if c in update else f"_t.{c}")
        ).alias(c)
        for c in others
    ]
    key = [F.when(inserted, F.col(f"s.`{k}`")).otherwise(F.col(f"t.`{k}`")).alias(k) for k in keys]
    return merged.select(*key, *picked).select(*target.columns)
