"""Load every input file exactly once, with a ledger of the files already loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER_SCHEMA = "path string, uri string, length bigint, modified timestamp, load_id bigint, forgotten boolean"
SOURCE = "_source_file"


class FileLedger:
    """Target, ledger and inbox of one feed.

    A load writes its rows below ``target/load_id=<n>`` and then its files to the
    ledger. If the job dies in between, the next run takes the same number again
    and overwrites the folder, so no row is doubled. Rows keep the file they came
    from, so files are forgotten and read again one by one. ``fmt`` is json (one
    object per line), csv (with a header), parquet or orc; every file of the inbox
    counts, compressed or not, whatever its suffix.
    """

    def __init__(self, spark: SparkSession, inbox: str, root: str, schema: T.StructType | str, fmt: str = "json"):
        self.spark, self.inbox, self.fmt = spark, inbox, fmt
        self.target, self.ledger_path = f"{root}/target", f"{root}/ledger"
        empty = spark.createDataFrame([], schema)
        self.schema = empty.schema

    def _exists(self, path: str) -> bool:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def ledger(self) -> DataFrame:
        """Latest entry per file; forgotten files count as not loaded."""
        if not self._exists(self.ledger_path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        entries = self.spark.read.schema(LEDGER_SCHEMA).parquet(self.ledger_path)
        last = entries.groupBy("path").agg(F.max_by(F.struct("uri", "length", "modified", "load_id", "forgotten"), F.struct("load_id", "forgotten")).alias("e"))
        return last.select("path", "e.*")

    def new_files(self) -> DataFrame:
        """Files that are not loaded, or changed since: a file is known by path, length and time."""
        listed = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(self.inbox)
            .select("path", F.col("_metadata.file_path").alias("uri"), "length", F.col("modificationTime").alias("modified"))
        )
        known = self.ledger().filter("NOT forgotten").select("path", "length", "modified")
        return listed.join(known, ["path", "length", "modified"], "left_anti")

    def _next_id(self) -> int:
        return (self.ledger().agg(F.max("load_id")).first()[0] or 0) + 1

    def _read(self, paths: list[str]) -> DataFrame:
        source = F.col("_metadata.file_path").alias(SOURCE)
        if self.fmt != "json":
            reader = self.spark.read.schema(self.schema).format(self.fmt)
            if self.fmt == "csv":
                reader = reader.option("header", True)
            return reader.load(paths).select("*", source)
        # The JSON reader matches names by exact case, so objects are read as maps first.
        found = F.from_json("value", "map<string,string>")
        lines = self.spark.read.text(paths).select(F.map_entries(found).alias("_e"), source)
        entries = lines.filter("_e IS NOT NULL")

        def field(f: T.StructField) -> Column:
            value = F.get(F.filter("_e", lambda e: F.lower(e["key"]) == f.name.lower()), F.lit(0))["value"]
            nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
            return (F.from_json(value, f.dataType) if nested else value.try_cast(f.dataType)).alias(f.name)

        return entries.select(*[field(f) for f in self.schema.fields], SOURCE)

    def load_new_files(self, max_files: int = 50_000) -> int:
        """Load all files not yet loaded; returns how many.

        Malformed rows are skipped, columns are matched by name ignoring case,
        absent columns are NULL. Only file names pass through the driver, at
        most ``max_files`` at a time; passes repeat until nothing is left.
        """
        loaded = 0
        while True:
            batch = self.new_files().limit(max_files).collect()
            if not batch:
                return loaded
            load_id = self._next_id()
            rows = self._read([r.path for r in batch])
            rows.write.mode("overwrite").parquet(f"{self.target}/load_id={load_id}")
            entries = [(r.path, r.uri, r.length, r.modified, load_id, False) for r in batch]
            self.spark.createDataFrame(entries, LEDGER_SCHEMA).write.mode("append").parquet(self.ledger_path)
            loaded += len(batch)

    def table(self) -> DataFrame:
        """Rows of the last load of each file, unless the file is forgotten."""
        if not self._exists(self.target):
            return self.spark.createDataFrame([], self.schema)
        added = [T.StructField(SOURCE, T.StringType()), T.StructField("load_id", T.LongType())]
        done = self.ledger().filter("NOT forgotten").select("load_id", F.col("uri").alias(SOURCE))
        rows = self.spark.read.schema(T.StructType([*self.schema.fields, *added])).parquet(self.target)
        return rows.join(done, ["load_id", SOURCE], "left_semi").drop("load_id", SOURCE)

    def forget(self, files: Column) -> int:
        """Mark exactly the files matching the condition on ``path`` as not loaded; returns how many."""
        gone = self.ledger().filter("NOT forgotten").filter(files).withColumn("forgotten", F.lit(True))
        n = gone.count()
        if n:
            columns = ("path", "uri", "length", "modified", "load_id", "forgotten")
            gone.select(*columns).write.mode("append").parquet(self.ledger_path)
        return n
