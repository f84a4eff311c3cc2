"""A served table by event date that follows on-time and late events, each date exactly once per change.

``streams.split_late`` keeps events that came in time by date, and late ones aside. A ledger has, for every version of a date,
the batches that went into it. A date is due when a later batch has rows for it; it is built again from all its events and
replaces its partition, and only then the ledger gets the new version. A run that dies in between is repeated and writes the
same partition again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.joins import null_safe_join
from millrace.sources.writers import overwrite_partitions
from millrace.streaming.streams import BATCH, read_batches

LEDGER = "event_date date, on_time_batch long, late_batch long, version long"


def late_events(spark: SparkSession, root: str, schema: T.StructType, ts: str) -> DataFrame:
    """Events that came in time and late ones, with ``event_date``, batch and side."""
    dated = T.StructType([*schema.fields, T.StructField("event_date", T.DateType())])
    on_time = read_batches(spark, f"{root}/on_time", dated).withColumn("late", F.lit(False))
    late = read_batches(spark, f"{root}/late", schema).withColumns({"event_date": F.col(ts).cast("date"), "late": F.lit(True)})
    return on_time.unionByName(late)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """All versions of all dates; none if nothing was served yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def due_dates(events: DataFrame, versions: DataFrame) -> DataFrame:
    """Dates with batches that no version has, and the version that they get."""
    newest = events.groupBy("event_date").agg(
        F.max(F.when(~F.col("late"), F.col(BATCH))).alias("on_time_batch"), F.max(F.when(F.col("late"), F.col(BATCH))).alias("late_batch")
    )
    known = versions.groupBy("event_date").agg(
        F.max("on_time_batch").alias("_on_time"), F.max("late_batch").alias("_late"), F.max("version").alias("_version")
    )
    none = F.lit(-1).cast("long")
    newer = lambda a, b: F.coalesce(F.col(a), none) > F.coalesce(F.col(b), none)
    both = null_safe_join(newest, known, ["event_date"], "left")
    both = both.filter(newer("on_time_batch", "_on_time") | newer("late_batch", "_late"))
    return both.select("event_date", "on_time_batch", "late_batch", (F.coalesce("_version", F.lit(0)) + 1).cast("long").alias("version"))


def serve_dates(
    spark: SparkSession, root: str, served: str, schema: T.StructType, ts: str, build: Callable[[DataFrame], DataFrame]
) -> None:
    """Bring the table at ``served`` (partitioned by ``event_date``) up to date. ``build`` makes its rows from the events of some
    dates and keeps ``event_date``. Only dates with new batches are read in full and rewritten; events without a time have
    the date NULL, a partition like any other."""
    path = f"{served}_versions"
    events = late_events(spark, root, schema, ts)
    due = due_dates(events, ledger(spark, path)).checkpoint()
    if due.isEmpty():
        return
    upto = due.select("event_date", F.col("on_time_batch").alias("_on_time"), F.col("late_batch").alias("_late"))
    rows = null_safe_join(events, upto, ["event_date"], "inner")
    # Batches that arrive meanwhile belong to the next version.
    rows = rows.filter(F.col(BATCH) <= F.when(F.col("late"), F.col("_late")).otherwise(F.col("_on_time")))
    overwrite_partitions(build(rows.drop("_on_time", "_late", "late", BATCH)), served, ["event_date"])
    due.coalesce(1).write.mode("append").parquet(path)
