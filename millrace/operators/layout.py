"""File layout, caching and plan inspection."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.joins import estimated_bytes
from millrace.operators.skew import MIN_PIECE_ROWS, cuts_not_above, heavy_keys, row_hash

TARGET_FILE_BYTES = 128 * 1024 * 1024


def file_sizes(spark: SparkSession, path: str, suffix: str = "parquet") -> DataFrame:
    """``(path, length)`` of the data files; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{suffix}")
        .load(path)
        .select("path", "length")
    )


def read_as_written(spark: SparkSession, path: str | list[str], base: str | None = None) -> DataFrame:
    """Parquet folder, or some files below ``base``, whose partition values stay text, so that ``01`` does not become ``1``."""
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        reader = spark.read if base is None else spark.read.option("basePath", base)
        return reader.parquet(*([path] if isinstance(path, str) else path))
    finally:
        spark.conf.set(name, before)


def file_count(df: DataFrame, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Files of about ``target_bytes`` that ``df`` is estimated to fill."""
    return max(1, math.ceil(estimated_bytes(df) / target_bytes))


def compact_files(
    spark: SparkSession,
    source: str,
    target: str,
    partition_columns: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
) -> int:
    """Rewrite a Parquet folder into files near ``target_bytes``; returns the task count.

    The range partitioner samples (partition columns, row hash), so a folder that
    holds most of the data is spread over many tasks and small folders share one.
    """
    total = file_sizes(spark, source).agg(F.sum("length")).first()[0] or 0
    files = max(1, math.ceil(total / target_bytes))
    rows = read_as_written(spark, source)
    plain = [c for c in rows.columns if c not in partition_columns]
    spread = rows.repartitionByRange(files, *partition_columns, row_hash(rows.select(*plain)))
    spread.write.mode("errorifexists").partitionBy(*partition_columns).parquet(target)
    return files


def sortable(df: DataFrame, column: str) -> Column:
    """A number that sorts as the column does; text sorts by its first six bytes."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.StringType):
        first = F.hex(F.substring(c.cast("binary"), 1, 6))
        return F.conv(F.rpad(first, 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def quantile_cuts(df: DataFrame, columns: Sequence[str], bits: int = 8, accuracy: int = 10_000) -> list[list[float]]:
    """For each column at most ``2 ** bits - 1`` cut points that divide it evenly; one pass for all."""
    steps = F.array(*[F.lit(i / 2**bits) for i in range(1, 2**bits)])
    row = df.agg(*[F.percentile_approx(sortable(df, c), steps, F.lit(accuracy)).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return [sorted(set(cuts or [])) for cuts in row]


def _bucket(value: Column, cuts: Sequence[float]) -> Column:
    """Number of cuts not above the value; NULL sorts first."""
    if not cuts:
        return F.lit(0)
    width = math.ceil(math.sqrt(len(cuts)))
    blocks = [F.array(*[F.lit(c) for c in cuts[i : i + width]]) for i in range(0, len(cuts), width)]
    return F.coalesce(F.when(value.isNotNull(), cuts_not_above(F.array(*blocks), value)), F.lit(0))


def zorder_key(df: DataFrame, columns: Sequence[str], bits: int = 8) -> Column:
    """Interleave the bits of the quantile buckets of the columns, first column highest."""
    cuts = quantile_cuts(df, columns, bits)
    buckets = [_bucket(sortable(df, c), q).cast("long") for c, q in zip(columns, cuts)]
    key = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for b in buckets:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(b, bit).bitwiseAND(F.lit(1).cast("long")))
    return key


def zorder_layout(df: DataFrame, columns: Sequence[str], files: int | None = None, bits: int = 8) -> DataFrame:
    """Order rows so that a filter on any of the columns can skip files. Columns may be
    numbers, dates, times or text; the number of files follows the size unless given."""
    keyed = df.withColumn("_z", zorder_key(df, columns, bits))
    spread = keyed.repartitionByRange(files or file_count(df), "_z", row_hash(df))
    return spread.sortWithinPartitions("_z").drop("_z")


def sort_layout(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Global order by the columns, for min/max skipping; a row hash splits frequent values."""
    spread = df.repartitionByRange(files or file_count(df), *columns, row_hash(df))
    return spread.sortWithinPartitions(*columns)


def bucket_layout(df: DataFrame, table: str, path: str, columns: Sequence[str], buckets: int) -> None:
    """Bucketed and sorted table; joins and groupings on the columns need no shuffle.

    Shuffling to the bucket count first makes each task write one bucket file.
    A bucket is always read by one task. A key that would fill more than two buckets
    is an error that names it; such a table is better written by ``sort_layout``,
    whose joins shuffle and can be split.
    """
    heavy = heavy_keys(df.select(*columns), columns, MIN_PIECE_ROWS, buckets).first()
    if heavy is not None:
        raise ValueError(f"key {tuple(heavy[c] for c in columns)} has {heavy['_rows']} rows, too many for one of {buckets} buckets")
    writer = df.repartition(buckets, *columns).write.format("parquet").mode("errorifexists")
    writer.bucketBy(buckets, *columns).sortBy(*columns).option("path", path).saveAsTable(table)


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` for reuse inside the block and release it afterwards."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def spread_partitions(df: DataFrame, n: int, by: Sequence[str] = ()) -> DataFrame:
    """Full shuffle to ``n`` partitions, by hash of the columns if given."""
    return df.repartition(n, *by)


def merge_partitions(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` partitions without a shuffle."""
    return df.coalesce(n)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    spark = df.sparkSession
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def plan_counts(df: DataFrame) -> dict[str, int]:
    """How often the operators that matter for cost occur in the physical plan."""
    tree = plan_text(df, "simple")
    names = ("Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "WindowGroupLimit", "CartesianProduct",
             "BroadcastNestedLoopJoin")
    return {n: len(re.findall(rf"[\s\-+:*()0-9]{n}\b", tree)) for n in names}
