"""Session catalog: tables over files, inserts, views and partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def external_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Make files queryable by name without loading them."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    return spark.table(name)


def create_table_as(spark: SparkSession, name: str, path: str, query: str) -> DataFrame:
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}' AS {query}")
    return spark.table(name)


def insert_rows(df: DataFrame, name: str, overwrite: bool = False) -> None:
    """Append to, or replace, the content of a table; columns are matched by name."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.insertInto(name, overwrite=overwrite)


def register_views(df: DataFrame, temp: str | None = None, global_temp: str | None = None) -> None:
    if temp:
        df.createOrReplaceTempView(temp)
    if global_temp:
        df.createOrReplaceGlobalTempView(global_temp)


def partitioned_table(spark: SparkSession, name: str, path: str, columns: str, partitions: str) -> None:
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({partitions}) LOCATION '{path}'")


def register_partition(spark: SparkSession, name: str, spec: str) -> None:
    """Make one new folder queryable, e.g. ``spec="dt='2026-01-01'"``."""
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec})")


def register_all_partitions(spark: SparkSession, name: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {name}")
