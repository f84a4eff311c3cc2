"""A change log with snapshots of its state, so that a point in time reads the nearest snapshot and the tail of the log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.cleansing import dedup_latest

VERSION = "version"


class SnapshotLog:
    """Versions of changes below ``root/log``, the last change per key every ``every`` versions below ``root/state``, and below
    ``root/index`` the times that each version spans.

    A version is appended once; the same version again replaces what it wrote. Changes may be late: a version may hold times
    before those of earlier versions. A snapshot keeps deletions, since a late change of a deleted key must not bring it back.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], seq: Sequence[str], every: int = 10, op: str = "_op"):
        self.spark, self.root, self.schema = spark, root, schema
        self.keys, self.seq, self.every, self.op = list(keys), list(seq), every, op
        time = schema[seq[0]].dataType
        self.index_schema = T.StructType(
            [
                T.StructField("low", time),
                T.StructField("high", time),
                T.StructField("has_state", T.BooleanType()),
                T.StructField(VERSION, T.LongType()),
            ]
        )

    def _read(self, part: str, schema: T.StructType) -> DataFrame:
        full = schema if part == "index" else T.StructType([*schema.fields, T.StructField(VERSION, T.LongType())])
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{part}")
        if not where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).parquet(f"{self.root}/{part}")

    def index(self) -> DataFrame:
        """``low, high, has_state, version``: one small row for each version."""
        return self._read("index", self.index_schema)

    def _last_changes(self, start: int, rows: DataFrame) -> DataFrame:
        """Last change per key, of the snapshot of version ``start`` and ``rows``; deletions are still there."""
        state = self._read("state", self.schema).filter(F.col(VERSION) == start).drop(VERSION)
        return dedup_latest(state.unionByName(rows), self.keys, [F.desc(s) for s in self.seq])

    def append(self, changes: DataFrame, version: int) -> None:
        """Add a version; the index comes last, so a version without its row there was not finished and is written again."""
        changes.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.root}/log/{VERSION}={version}")
        known = self.index().filter(F.col(VERSION) < version)
        start = known.filter("has_state").agg(F.max(VERSION)).first()[0]
        start = -1 if start is None else start
        due = known.filter(F.col(VERSION) > start).count() + 1 >= self.every
        if due:
            tail = self._read("log", self.schema).filter((F.col(VERSION) > start) & (F.col(VERSION) <= version)).drop(VERSION)
            self._last_changes(start, tail).write.mode("overwrite").parquet(f"{self.root}/state/{VERSION}={version}")
        written = self.spark.read.schema(self.schema).parquet(f"{self.root}/log/{VERSION}={version}")
        span = written.agg(F.min(self.seq[0]).alias("low"), F.max(self.seq[0]).alias("high"), F.lit(due).alias("has_state"))
        span.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/index/{VERSION}={version}")

    def nearest(self, at: object) -> int:
        """Version of the last snapshot that holds no change after ``at``; -1 if there is none. Highs of all versions up to it
        count, as a version may be late."""
        kind = self.schema[self.seq[0]].dataType
        rows = self.index()
        first_after = rows.filter(F.col("high") > F.lit(at).cast(kind)).agg(F.min(VERSION)).first()[0]
        usable = rows.filter("has_state") if first_after is None else rows.filter(F.col("has_state") & (F.col(VERSION) < first_after))
        found = usable.agg(F.max(VERSION)).first()[0]
        return -1 if found is None else found

    def state_as_of(self, at: object) -> DataFrame:
        """State after all changes up to and including ``at``. Log files up to the snapshot are not read."""
        kind, start = self.schema[self.seq[0]].dataType, self.nearest(at)
        last = self.index().agg(F.coalesce(F.max(VERSION), F.lit(-1))).first()[0]  # a version without an index row is not finished
        tail = self._read("log", self.schema).filter((F.col(VERSION) > start) & (F.col(VERSION) <= last))
        tail = tail.filter(F.col(self.seq[0]) <= F.lit(at).cast(kind))
        return self._last_changes(start, tail.drop(VERSION)).filter(F.col(self.op) != "D").drop(self.op)
