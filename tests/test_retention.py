"""Retention by folders: old ones go, the edge is rewritten, later ones keep their files."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from millrace.sources.writers import purge_partitions, write_partitioned
from tests.conftest import rows


def files_of(path):
    return {(f, n): os.stat(f"{path}/{f}/{n}").st_mtime_ns for f in os.listdir(path) if "=" in f for n in os.listdir(f"{path}/{f}")}


def test_purge_by_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(400).selectExpr("id", "date_add(date'2023-06-01', cast(id as int)) as day")
    given = days.withColumn("month", F.date_format("day", "yyyy-MM")).union(spark.sql("select 999L, null, null"))
    write_partitioned(given, path, ["month"])
    old = files_of(path)
    inside = F.col("day") >= F.lit("2024-01-15").cast("date")
    gone = purge_partitions(spark, path, "month", "2024-01", inside, str(tmp_path / "s"))
    assert gone == ["2023-06", "2023-07", "2023-08", "2023-09", "2023-10", "2023-11", "2023-12"]
    want = rows(given.filter(inside | F.col("day").isNull()), "id", "day", "month")
    assert rows(spark.read.parquet(path), "id", "day", "month") == want
    now = files_of(path)
    late = {k for k in old if k[0] > "month=2024-01" or "HIVE" in k[0]}
    assert late and all(now[k] == old[k] for k in late)
    assert purge_partitions(spark, path, "month", "2024-01", inside, str(tmp_path / "s2")) == [] and files_of(path) == now
    assert purge_partitions(spark, path, "month", "2024-01", F.lit(False), str(tmp_path / "s3")) == ["2024-01"]
