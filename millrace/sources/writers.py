"""Writers. None of them overwrites a path that its own input reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``mode`` is overwrite, append, ignore or errorifexists."""
    df.write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str], mode: str = "errorifexists") -> None:
    """Hive-style folders. The rebalance hint lets AQE merge small folders' tasks
    and split a folder that holds a large share of the rows."""
    df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Replace exactly the partitions that occur in ``df``; running it again changes nothing."""
    writer = df.hint("rebalance", *columns).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def publish_partitions(df: DataFrame, staging: str, path: str, columns: Sequence[str]) -> None:
    """Build outside, then swap in: the result is complete in ``staging`` before
    any partition of ``path`` is touched, so ``df`` may itself read ``path``."""
    write_partitioned(df, staging, columns)
    built = df.sparkSession.read.schema(df.schema).parquet(staging).select(*df.columns)
    overwrite_partitions(built, path, columns)


def purge_partitions(spark: SparkSession, path: str, column: str, first_kept: str, inside: Column, staging: str) -> list[str]:
    """Retention on a partitioned table: folders of ``column`` before ``first_kept`` go without
    being read, the folder of ``first_kept`` keeps the rows for which ``inside`` is true, and later
    folders are not touched. Returns the values that went.

    Values are compared as text, so they need a sortable form, such as a year or an ISO date. Rows
    without a value (Hive's default partition) have no age and stay. A rerun changes nothing.
    """
    rows = spark.read.parquet(path)
    edge = rows.filter(F.col(column).cast("string") == first_kept)
    kept = edge.filter(F.coalesce(inside, F.lit(False)))
    before, after = edge.count(), kept.count()
    if 0 < after < before:
        publish_partitions(kept, staging, path, [column])
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for folder in files.listStatus(where):
        name, _, value = folder.getPath().getName().partition("=")
        if name != column or value == "__HIVE_DEFAULT_PARTITION__":
            continue
        if value < first_kept or (value == first_kept and before and not after):
            files.delete(folder.getPath(), True)
            gone.append(value)
    return sorted(gone)


def export_query(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def quarantine_write(good: DataFrame, bad: DataFrame, good_path: str, bad_path: str) -> None:
    good.write.mode("errorifexists").parquet(good_path)
    bad.write.mode("errorifexists").parquet(bad_path)
