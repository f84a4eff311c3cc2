"""Small helpers that several operators of this package share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import checkpoint_root, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def on_workers(df: DataFrame) -> SparkSession:
    """Session of ``df``, whose Python workers will look for this package where the driver
    found it. Executors that have it installed do not need that."""
    sc = df.sparkSession.sparkContext
    root = str(Path(__file__).resolve().parents[2])
    known = sc.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        sc.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    return df.sparkSession


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prepared(spark: SparkSession) -> SparkSession:
    """Make sure that ``checkpoint()`` has its shared folder."""
    checkpoint_root(spark)
    return spark


def held_out(key: str = "doc_id") -> Column:
    """Rows kept away from learning: a quarter of the ids, by checksum."""
    return F.crc32(F.col(key).cast("string")) % 4 == 2


def slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items whose lengths add up to ``most`` or so; a single
    longer item has a range of its own."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(lengths):
        yield start, len(lengths)
