"""Readers. Production readers take a schema; inference is for exploration."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; empty fields are NULL. Without a schema the types are inferred.

    A schema with a ``_corrupt_record`` field keeps malformed lines in it.
    """
    reader = spark.read.option("header", True).option("nullValue", "").option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path)


def sql_on_files(spark: SparkSession, path: str, select: str, rest: str = "", fmt: str = "parquet") -> DataFrame:
    """``SELECT ... FROM parquet.`path` ...``"""
    return spark.sql(f"SELECT {select} FROM {fmt}.`{path}` {rest}")


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    partition: tuple[str, object, object, int] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read; ``partition`` is (column, low, high, count) for parallel ranges."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if partition:
        column, low, high, count = partition
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(count),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **settings: object) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **settings)).load()


def parse_log_lines(df: DataFrame, line: str, pattern: str, fields: Mapping[str, str]) -> DataFrame:
    """Named fields from the groups of one pattern, with types; a line that does not match gives NULLs."""
    groups = F.when(F.col(line).rlike(pattern), F.col(line))
    parts = {
        name: F.nullif(F.regexp_extract(groups, pattern, i), F.lit("")).try_cast(kind)
        for i, (name, kind) in enumerate(fields.items(), start=1)
    }
    return df.withColumns(parts)


@contextmanager
def grouped_inputs(spark: SparkSession, partition_bytes: int, open_cost_bytes: int) -> Iterator[None]:
    """Inside the block, scans put many small files into one task.

    The settings count when a query runs, so run it inside the block.
    """
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.files.openCostInBytes": str(open_cost_bytes),
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def dataset_profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, NULLs, smallest and largest value as text. One pass."""
    fields = df.schema.fields
    orderable = lambda f: not isinstance(f.dataType, (T.MapType, T.VariantType))
    edge = lambda fn, f: fn(F.col(f.name)).cast("string") if orderable(f) else F.lit(None).cast("string")
    stats = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(f.name).isNull()).alias("n_nulls"),
            edge(F.min, f).alias("lowest"),
            edge(F.max, f).alias("highest"),
        )
        for f in fields
    ]
    return df.agg(F.array(*stats).alias("_s")).select(F.inline("_s"))


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per folder."""
    from millrace.operators.layout import file_sizes

    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return file_sizes(spark, path).groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes")
    )
