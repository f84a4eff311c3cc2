"""Incremental loads against data that is already there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from millrace.operators.cleansing import dedup_latest
from millrace.operators.joins import newer_than_target, null_safe_join
from millrace.operators.merge import merge_upsert


def watermark_increment(source: DataFrame, target: DataFrame, column: str, inclusive: bool = False) -> DataFrame:
    """Source rows newer than anything loaded; all rows if nothing is loaded.

    ``inclusive`` also returns rows that tie with the highest loaded value; use
    it together with a merge on the key.
    """
    return newer_than_target(source, target, column, inclusive)


def incremental_model(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    column: str,
    latest: Sequence[Column],
) -> DataFrame:
    """First run builds from the whole source; later runs merge only the newer rows."""
    if target is None:
        return dedup_latest(source, keys, latest)
    return merge_upsert(target, watermark_increment(source, target, column, inclusive=True), keys, latest)


def late_partition_reprocess(facts: DataFrame, late: DataFrame, date_column: str) -> DataFrame:
    """All rows, old and late, of exactly the days that received late rows; rows without
    a day are a partition like any other.

    Hand the result to a dynamic partition overwrite.
    """
    days = late.select(date_column).distinct()
    touched = null_safe_join(facts, days, [date_column], "left_semi")
    return touched.select(*facts.columns).unionByName(late.select(*facts.columns))
