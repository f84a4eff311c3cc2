"""Typing, cleansing and deduplication of dirty rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import clamp_negative, or_unknown, text_to_date, text_to_number


def apply_mapping(df: DataFrame, mapping: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Project ``(source, target, type)`` triples; values that do not fit become NULL."""
    return df.select(*[F.col(src).try_cast(kind).alias(dst) for src, dst, kind in mapping])


def resolve_choice(df: DataFrame, column: str, action: str) -> DataFrame:
    """Settle a column that is sometimes a number and sometimes text.

    ``cast:<type>`` keeps one column; ``make_cols`` splits it into
    ``<column>_int`` and ``<column>_string``, exactly one of them filled.
    """
    if action.startswith("cast:"):
        return df.withColumn(column, F.col(column).try_cast(action.removeprefix("cast:")))
    if action != "make_cols":
        raise ValueError(f"unknown action {action!r}")
    number = F.col(column).try_cast("long")
    return df.withColumns(
        {f"{column}_int": number, f"{column}_string": F.when(number.isNull(), F.col(column))}
    ).drop(column)


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


def fill_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(defaults))


def clamp_column(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, clamp_negative(column))


def fill_unknown(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, or_unknown(column))


def drop_duplicates_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; which one is left open."""
    return df.dropDuplicates(list(keys))


def dedup_latest(df: DataFrame, keys: Sequence[str], latest: Sequence[Column]) -> DataFrame:
    """First row per key in the order ``latest``.

    The ``row_number() <= 1`` form lets Spark keep one row per key on the map
    side (WindowGroupLimit), so a key with very many copies never reaches a
    single task whole.
    """
    w = Window.partitionBy(*keys).orderBy(*latest)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn <= 1").drop("_rn")


def dedup_then_filter(df: DataFrame, keys: Sequence[str], latest: Sequence[Column], keep: Column) -> DataFrame:
    """The latest row decides: a key whose latest row fails ``keep`` disappears."""
    return dedup_latest(df, keys, latest).filter(keep)


def filter_then_dedup(df: DataFrame, keys: Sequence[str], latest: Sequence[Column], keep: Column) -> DataFrame:
    """The latest row among those that pass ``keep``."""
    return dedup_latest(df.filter(keep), keys, latest)


def referential_filter(df: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None) -> DataFrame:
    """Rows whose key exists in ``parent``. A semi join cannot multiply rows."""
    keys = parent.select(F.col(parent_column or column).alias(column))
    return df.join(keys, column, "left_semi")


def type_orders(raw: DataFrame) -> DataFrame:
    """Typed staging rows: numeric amount, lower-case status, date beside the time text."""
    return raw.withColumns(
        {
            "amount": text_to_number("amount"),
            "status": F.lower("status"),
            "order_date": text_to_date("order_ts"),
        }
    )


def latest_order_first() -> list[Column]:
    """Newest time first; the other columns only settle ties."""
    return [F.desc("order_ts"), F.asc("status"), F.asc("amount"), F.asc("customer_id"), F.asc("product_id")]


def clean_orders(raw: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Latest row per order, kept if completed, positive and with known references."""
    keep = (F.col("status") == "completed") & (F.col("amount") > 0)
    clean = dedup_then_filter(type_orders(raw), ["order_id"], latest_order_first(), keep)
    return referential_filter(referential_filter(clean, customers, "customer_id"), products, "product_id")


def standardize_orders(raw: DataFrame) -> DataFrame:
    """The lenient variant: everything not cancelled with a positive amount."""
    keep = (F.col("status") != "cancelled") & (F.col("amount") > 0)
    return filter_then_dedup(type_orders(raw), ["order_id"], latest_order_first(), keep)


def quarantine_split(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with the array ``reason`` of the rules they break.

    A rule that evaluates to NULL counts as broken.
    """
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    tagged = df.withColumn("reason", F.array_compact(F.array(*broken)))
    return tagged.filter(F.size("reason") == 0).drop("reason"), tagged.filter(F.size("reason") > 0)


def sample_by_key(df: DataFrame, keys: Sequence[str], fraction: float, seed: str = "42") -> DataFrame:
    """About ``fraction`` of the keys with all their rows: those whose digest is small. No shuffle, the same rows in every
    run, and a larger fraction holds a smaller one. A NULL part of a key counts as empty text."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), text)), 1, 8), 16, 10).cast("long")
    return df.filter(place < F.lit(fraction * 2**32))
