"""User-defined function surface: Python, vectorized, SQL, and per-partition.

The built-in twin of each function is in :mod:`millrace.functions.columns`;
prefer that. These exist for logic that has no built-in form.
"""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import HIGH_FROM


def bucket_builtin(c: Column) -> Column:
    return F.when(c >= HIGH_FROM, "high").otherwise("low")


def bucket_udf() -> Callable[[Column], Column]:
    """Row at a time; a missing value is low. Defined inside, so that it travels
    to the workers by value and they need not have this package."""
    limit = HIGH_FROM

    def bucket(value):
        return "high" if value is not None and value >= limit else "low"

    return F.udf(bucket, "string")


def bucket_pandas_udf() -> Callable[[Column], Column]:
    limit = HIGH_FROM

    @F.pandas_udf("string")
    def bucket(values: pd.Series) -> pd.Series:
        return values.ge(limit).map({True: "high", False: "low"})

    return bucket


def register_sql_function(spark: SparkSession, name: str, arguments: str, returns: str, body: str) -> None:
    """Session-scoped SQL function; Catalyst inlines its body."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {returns} RETURN {body}")


def map_partitions(
    df: DataFrame,
    setup: Callable[[], object],
    work: Callable[[object, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """Run ``setup`` once per partition and ``work`` on every Arrow batch of it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup()
        for batch in batches:
            yield work(resource, batch)

    return df.mapInPandas(run, schema)
