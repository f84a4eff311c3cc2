from __future__ import annotations

import gzip
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators import cleansing
from millrace.sources import catalog, readers, writers
from millrace.sources.ledger import FileLedger
from tests.conftest import rows, same_rows


def test_csv_blank_is_null_and_bad_lines_are_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,amount,name\n1,2.5,x\n2,,y\n3,oops,z\n")
    df = readers.read_csv_typed(spark, str(tmp_path), "id int, amount double, name string, _corrupt_record string")
    assert rows(df) == [(1, 2.5, "x", None), (2, None, "y", None), (3, None, "z", "3,oops,z")]
    inferred = readers.read_csv_typed(spark, str(tmp_path))
    assert dict(inferred.dtypes)["id"] == "int"


def test_multi_line_json(spark, tmp_path):
    doc = [{"sku": "a", "qty": 1}, {"sku": "b", "qty": 2}]
    (tmp_path / "a.json").write_text(json.dumps(doc, indent=2))
    assert rows(readers.read_json(spark, str(tmp_path), "sku string, qty int", multi_line=True)) == [("a", 1), ("b", 2)]


def test_jdbc_options():
    """No database is started here, so only the options are checked."""
    options = readers.jdbc_options("jdbc:x://h/db", "orders", "u", "p", ("order_id", 0, 1_000_000, 64))
    assert options["numPartitions"] == "64" and options["partitionColumn"] == "order_id" and options["dbtable"] == "orders"
    assert "user" not in readers.jdbc_options("jdbc:x://h/db", "orders")


def test_log_lines(spark):
    df = spark.createDataFrame([("2026-01-01 ERROR 17",), ("nonsense",)], "line string")
    parsed = readers.parse_log_lines(df, "line", r"^(\S+) (\w+) (\d+)$", {"day": "date", "level": "string", "code": "int"})
    assert [(str(r.day), r.level, r.code) for r in parsed.collect()] == [("2026-01-01", "ERROR", 17), ("None", None, None)]


def test_write_modes(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    writers.write_parquet(df, path)
    with pytest.raises(AnalysisException):
        writers.write_parquet(df, path)
    writers.write_parquet(df, path, "ignore")
    writers.write_parquet(df, path, "append")
    assert spark.read.parquet(path).count() == 6
    writers.write_parquet(df, path, "overwrite")
    assert spark.read.parquet(path).count() == 3


def test_partition_overwrite_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select("id", (F.col("id") % 4).cast("int").alias("p"))
    writers.write_partitioned(df, path, ["p"])
    new = df.filter("p = 1").withColumn("id", -F.col("id"))
    for _ in range(2):
        writers.overwrite_partitions(new, path, ["p"])
    back = spark.read.schema(df.schema).parquet(path)
    assert same_rows(back, df.filter("p <> 1").union(new))
    writers.publish_partitions(back.filter("p = 2").limit(5), str(tmp_path / "s"), path, ["p"])
    assert spark.read.schema(df.schema).parquet(path).filter("p = 2").count() == 5


def test_partition_filter_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_partitioned(spark.range(10).selectExpr("id", "id % 2 AS p"), path, ["p"])
    plan = spark.read.parquet(path).filter("p = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_views_and_tables(spark, tmp_path):
    writers.write_parquet(spark.range(5), str(tmp_path / "f"))
    assert catalog.external_table(spark, "t_ext", str(tmp_path / "f")).count() == 5
    catalog.create_table_as(spark, "t_ctas", str(tmp_path / "c"), "SELECT id FROM t_ext WHERE id > 1")
    catalog.insert_rows(spark.range(2), "t_ctas")
    assert spark.table("t_ctas").count() == 5
    catalog.insert_rows(spark.range(2), "t_ctas", overwrite=True)
    assert spark.table("t_ctas").count() == 2
    catalog.register_views(spark.range(4), "v_tmp", "v_glob")
    assert spark.sql("SELECT count(*) FROM v_tmp JOIN global_temp.v_glob USING (id)").first()[0] == 4


def test_profile_and_inventory(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    assert rows(readers.dataset_profile(df)) == [("n", "int", 2, 0, "1", "2"), ("s", "string", 2, 1, "a", "a")]
    df.repartition(2).write.parquet(str(tmp_path / "p"))
    files = readers.file_inventory(spark, str(tmp_path / "p")).first()
    assert files.n_files >= 1 and files.n_bytes > 0


def test_quarantine_null_rule_is_broken(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, -1.0)], "id int, amount double")
    good, bad = cleansing.quarantine_split(df, {"amount": F.col("amount") > 0, "odd": F.col("id") % 2 == 1})
    assert rows(good, "id") == [(1,)]
    assert rows(bad, "id", "reason") == [(2, ["amount", "odd"]), (3, ["amount"])]


def test_two_dedup_orders_differ(spark):
    df = spark.createDataFrame([(1, 1, "completed"), (1, 2, "cancelled")], "id int, ts int, status string")
    keep, latest = F.col("status") == "completed", [F.desc("ts")]
    assert cleansing.dedup_then_filter(df, ["id"], latest, keep).isEmpty()
    assert rows(cleansing.filter_then_dedup(df, ["id"], latest, keep), "ts") == [(1,)]


@pytest.fixture
def feed(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    return inbox, FileLedger(spark, str(inbox), str(tmp_path / "feed"), "id int, amount double, tags array<string>")


def test_each_file_is_loaded_once(feed):
    inbox, ledger = feed
    (inbox / "a.json").write_text('{"ID": 1, "Amount": 2.5, "tags": ["x"]}\nnot json\n{"id": 2, "extra": true}\n')
    assert ledger.load_new_files() == 1
    assert ledger.load_new_files() == 0
    assert rows(ledger.table(), "id", "amount", "tags") == [(1, 2.5, ["x"]), (2, None, None)]
    for n in range(5):
        (inbox / f"b{n}.json").write_text(json.dumps({"id": 10 + n}))
    assert ledger.load_new_files(max_files=2) == 5
    assert ledger.table().count() == 7


def test_forgotten_files_are_read_again(feed):
    inbox, ledger = feed
    (inbox / "a.json").write_text('{"id": 1}')
    ledger.load_new_files()
    (inbox / "b.json").write_text('{"id": 2}')
    ledger.load_new_files()
    (inbox / "b.json").write_text('{"id": 3}')
    assert ledger.forget(F.col("path").endswith("b.json")) == 1
    assert rows(ledger.table(), "id") == [(1,)]
    assert ledger.load_new_files() == 1
    assert rows(ledger.table(), "id") == [(1,), (3,)]


def test_compressed_and_rewritten_files_and_single_backfill(feed):
    inbox, ledger = feed
    with gzip.open(inbox / "a.json.gz", "wt") as f:
        f.write('{"id": 1}')
    (inbox / "b.txt").write_text('{"id": 2}')
    (inbox / "c.json").write_text('{"id": 3}')
    assert ledger.load_new_files() == 3
    (inbox / "c.json").write_text('{"id": 4, "amount": 1}')
    assert ledger.load_new_files() == 1
    assert rows(ledger.table(), "id") == [(1,), (2,), (4,)]
    assert ledger.forget(F.col("path").endswith("b.txt")) == 1
    assert rows(ledger.table(), "id") == [(1,), (4,)]
    assert ledger.load_new_files() == 1
    assert rows(ledger.table(), "id") == [(1,), (2,), (4,)]


def test_csv_feed(spark, tmp_path):
    inbox = tmp_path / "csv"
    inbox.mkdir()
    (inbox / "a.csv").write_text("id,amount\n1,2.5\n2,\n")
    ledger = FileLedger(spark, str(inbox), str(tmp_path / "feed_csv"), "id int, amount double", "csv")
    assert ledger.load_new_files() == 1 and rows(ledger.table(), "id", "amount") == [(1, 2.5), (2, None)]


def test_load_survives_a_crash_before_the_ledger_entry(feed, spark):
    inbox, ledger = feed
    (inbox / "a.json").write_text('{"id": 1}')
    spark.range(3).selectExpr("CAST(id AS int) AS id").write.parquet(f"{ledger.target}/load_id=1")
    assert ledger.table().isEmpty()
    ledger.load_new_files()
    assert rows(ledger.table(), "id") == [(1,)]
