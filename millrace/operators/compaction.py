"""Compaction that touches small files only, with a swap that can be taken up again after a crash.

Small files of one folder are packed into bins of the target size. A pass writes the merged files to a hidden folder, then
commits a list of what is added and what is replaced by renaming one file, then moves and deletes. Before the commit nothing
has changed; after it any later call finishes the swap.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.layout import TARGET_FILE_BYTES, read_as_written

COMMITTED = "_replacement.json"


class _Files:
    """The few file-system calls that a swap needs, on any store that Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.root = root.rstrip("/")
        self.fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def move(self, old: str, new: str) -> None:
        if not self.fs.rename(self._path(old), self._path(new)):
            raise OSError(f"cannot move {old} to {new}")

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def write(self, path: str, text: str) -> None:
        out = self.fs.create(self._path(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, uri, folder, length`` of the visible Parquet files below ``path``; contents are not read."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    )
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")
    return found.select(F.col("path").alias("file"), F.col("_metadata.file_path").alias("uri"), folder, "length")


def small_file_bins(files: DataFrame, target_bytes: int, small_share: float = 0.75) -> DataFrame:
    """``files`` that are worth merging, with a bin: files of one folder, smallest first, that fill a target file. A bin
    of one file has nothing to merge with and is left out."""
    small = files.filter(F.col("length") < small_share * target_bytes)
    order = Window.partitionBy("folder").orderBy("length", "file")
    before = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    binned = small.withColumn("bin", F.floor(before / target_bytes).cast("int"))
    return binned.withColumn("files", F.count(F.lit(1)).over(Window.partitionBy("folder", "bin"))).filter("files > 1").drop("files")


def finish_replacement(spark: SparkSession, path: str) -> bool:
    """Carry out a committed swap that was interrupted; says whether there was one. It may be repeated at any point."""
    files = _Files(spark, path)
    manifest = f"{files.root}/{COMMITTED}"
    if not files.exists(manifest):
        return False
    swap = json.loads(files.read(manifest))
    for old, new in swap["added"]:
        if files.exists(old):
            files.move(old, new)
    for old in swap["replaced"]:
        files.delete(old)
    files.delete(swap["staged"])
    files.delete(manifest)
    return True


def _stage(spark: SparkSession, path: str, picked: list[Row], columns: Sequence[str], staged: str) -> None:
    """Write each bin as one file below ``staged``, in the folders of the partition columns."""
    rows = read_as_written(spark, [r.file for r in picked], path).withColumn("_uri", F.col("_metadata.file_path"))
    # Bins are numbered per folder, so the number and the partition values name a file.
    bins = spark.createDataFrame([(r.uri, r.bin) for r in picked], "_uri string, bin_no int")
    dealt = rows.join(F.broadcast(bins), "_uri").drop("_uri").repartition("bin_no", *columns)
    dealt.write.partitionBy(*columns, "bin_no").parquet(staged)


def compact_small_files(
    spark: SparkSession,
    path: str,
    partition_columns: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
    small_share: float = 0.75,
    files_per_pass: int = 2000,
) -> int:
    """Merge files below ``small_share`` of the target size with others of their folder, in place; returns how many files
    were merged. Files near the target size keep their name and time, and a run without small files does nothing.

    A pass handles at most ``files_per_pass`` files, whose names pass through the driver, and passes follow until nothing is
    left to merge. Readers of a pass that is being swapped should call ``finish_replacement`` first.
    """
    finish_replacement(spark, path)
    files, merged = _Files(spark, path), 0
    while True:
        picked = small_file_bins(data_files(spark, path), target_bytes, small_share)
        names = picked.orderBy("folder", "bin", "file").limit(files_per_pass).collect()
        if len(names) < 2:
            return merged
        run = uuid.uuid4().hex
        staged = f"{files.root}/_staged_{run}"
        _stage(spark, path, names, partition_columns, staged)
        added = []
        for r in data_files(spark, staged).collect():
            inside = r.folder.split(f"_staged_{run}", 1)[1].rsplit("/", 1)[0]
            added.append((r.file, f"{files.root}{inside}/compact-{run}-{len(added):05d}.parquet"))
        swap = {"added": added, "replaced": [n.file for n in names], "staged": staged}
        files.write(f"{staged}/_swap.json", json.dumps(swap))
        files.move(f"{staged}/_swap.json", f"{files.root}/{COMMITTED}")
        finish_replacement(spark, path)
        merged += len(names)
