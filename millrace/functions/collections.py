"""Array and map expressions for the usual list and dictionary exercises."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, array: Column, name: str, *keep: str | Column) -> DataFrame:
    """One row per non-NULL element, beside the columns ``keep``.

    For a plain ``explode`` Catalyst adds filters on the array's size, which
    compute an expensive array expression again; the outer form does not.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def map_filter_reduce(
    array: Column,
    keep: Callable[[Column], Column],
    change: Callable[[Column], Column],
    start: Column,
    combine: Callable[[Column, Column], Column],
) -> Column:
    return F.aggregate(F.transform(F.filter(array, keep), change), start, combine)


def flatten_nested(nested: Column) -> Column:
    return F.flatten(nested)


def ordered_distinct(array: Column) -> Column:
    """Distinct elements in order of first appearance."""
    return F.array_distinct(array)


def common_elements(a: Column, b: Column) -> Column:
    return F.array_intersect(a, b)


def is_subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) == 0


def map_of(keys: Column, values: Column) -> Column:
    return F.map_from_arrays(keys, values)


def invert_map(m: Column) -> Column:
    """Swap keys and values. When several keys share a value the last one stays,
    as when a dictionary is rebuilt entry by entry."""
    swapped = F.transform(F.map_entries(m), lambda e: F.struct(e["value"].alias("k"), e["key"].alias("v")))
    last = F.filter(
        swapped,
        lambda e, i: ~F.exists(F.slice(swapped, i + 2, F.size(swapped)), lambda later: later["k"] == e["k"]),
    )
    return F.map_from_entries(last)
