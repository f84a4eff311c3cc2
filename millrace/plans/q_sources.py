"""Sources, sinks, catalog and incremental file loads."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.functions.columns import text_to_date
from millrace.operators import cleansing
from millrace.plans import roles
from millrace.plans.registry import query, table
from millrace.session import scratch_name, scratch_path
from millrace.sources import catalog, profile, readers, writers
from millrace.sources.ledger import FileLedger

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
ORDER_SELECT = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders"


@query(
    "read_parquet",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag = 'R'""",
)
def read_parquet(spark, sf_dir):
    rows = readers.read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    late = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    return rows.filter(late & (F.col("l_returnflag") == "R")).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "read_csv_typed",
    f"""WITH {roles.RAW_ORDERS}
        SELECT order_id, customer_id, quantity, TRY_CAST(NULLIF(amount, '') AS DOUBLE) AS amount, status, order_ts
        FROM raw_orders""",
)
def read_csv_typed(spark, sf_dir):
    path = scratch_path(spark, "csv")
    columns = ["order_id", "customer_id", "quantity", "amount", "status", "order_ts"]
    writers.export_query(roles.raw_orders(spark, sf_dir).select(*columns), path)
    schema = "order_id bigint, customer_id bigint, quantity bigint, amount double, status string, order_ts string"
    return readers.read_csv_typed(spark, path, schema)


@query("read_json_multiline", "SELECT * FROM supplier")
def read_json_multiline(spark, sf_dir):
    """Suppliers as JSON documents of up to 100,000 objects, one document per file."""
    path = scratch_path(spark, "json")
    rows = table(spark, sf_dir, "supplier")
    objects = F.collect_list(F.struct(*rows.columns))
    documents = rows.groupBy(F.floor(F.col("s_suppkey") / 100_000).alias("doc")).agg(
        F.to_json(objects, {"pretty": "true"}).alias("value")
    )
    documents.write.partitionBy("doc").text(path)
    return readers.read_json(spark, path, rows.schema, multi_line=True).select(*rows.columns)


@query(
    "read_text_lines",
    """SELECT value, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents)
       GROUP BY value""",
)
def read_text_lines(spark, sf_dir):
    path = scratch_path(spark, "text")
    table(spark, sf_dir, "documents").select("text").write.option("lineSep", "\n").text(path)
    return readers.read_text_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("read_orc", "SELECT * FROM orders")
def read_orc(spark, sf_dir):
    path = scratch_path(spark, "orc")
    table(spark, sf_dir, "orders").write.orc(path)
    return readers.read_orc(spark, path)


@query("sql_on_files", ORDER_SELECT + " WHERE o_totalprice > 200000")
def sql_on_files(spark, sf_dir):
    return readers.sql_on_files(
        spark, f"{sf_dir}/orders.parquet", ", ".join(ORDER_COLUMNS), "WHERE o_totalprice > 200000"
    )


@query(
    "external_table",
    """SELECT c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
)
def external_table(spark, sf_dir):
    """Cold order files, named but not loaded, joined with customers."""
    cold = catalog.external_table(spark, scratch_name("cold_orders"), f"{sf_dir}/orders.parquet")
    per_customer = cold.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("_n"))
    hot = table(spark, sf_dir, "customer")
    joined = per_customer.join(hot, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.sum("_n").alias("n"))


URL_PATTERN = r"^([a-z]+)://([^/:?#]+)(?::([0-9]+))?(/[^?#]*)?(?:\?([^#]*))?(?:#(.*))?$"


@query(
    "parse_log_lines",
    rf"""SELECT page_id, NULLIF(regexp_extract(url, '{URL_PATTERN}', 1), '') AS scheme,
                NULLIF(regexp_extract(url, '{URL_PATTERN}', 2), '') AS host,
                TRY_CAST(NULLIF(regexp_extract(url, '{URL_PATTERN}', 3), '') AS INTEGER) AS port,
                NULLIF(regexp_extract(url, '{URL_PATTERN}', 4), '') AS path,
                NULLIF(regexp_extract(url, '{URL_PATTERN}', 5), '') AS args,
                NULLIF(regexp_extract(url, '{URL_PATTERN}', 6), '') AS fragment FROM pages""",
)
def parse_log_lines(spark, sf_dir):
    fields = {"scheme": "string", "host": "string", "port": "int", "path": "string", "args": "string", "fragment": "string"}
    rows = table(spark, sf_dir, "pages").select("page_id", "url")
    return readers.parse_log_lines(rows, "url", URL_PATTERN, fields).drop("url")


@query(
    "write_parquet_modes",
    """SELECT * FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT * FROM orders WHERE o_orderkey % 3 = 0""",
)
def write_parquet_modes(spark, sf_dir):
    """A first write, refused where something is; that overwritten by one part, another appended, a last one ignored."""
    path = scratch_path(spark, "modes")
    rows = table(spark, sf_dir, "orders")
    writers.write_parquet(rows, path, "errorifexists")
    try:
        writers.write_parquet(rows, path, "errorifexists")
    except AnalysisException as refused:
        if refused.getCondition() != "PATH_ALREADY_EXISTS":
            raise
    else:
        raise AssertionError("a second write was not refused")
    writers.write_parquet(rows.filter("o_orderkey % 2 = 0"), path, "overwrite")
    writers.write_parquet(rows.filter("o_orderkey % 3 = 0"), path, "append")
    writers.write_parquet(rows, path, "ignore")
    return spark.read.parquet(path)


@query("write_partitioned", "SELECT event_id, user_id, value, CAST(ts AS DATE) AS event_date FROM events")
def write_partitioned(spark, sf_dir):
    path = scratch_path(spark, "by_date")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", F.col("ts").cast("date").alias("event_date"))
    writers.write_partitioned(events, path, ["event_date"])
    return spark.read.schema(events.schema).parquet(path)


YEARLY = "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders"


def _yearly(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"))


@query(
    "overwrite_partition",
    f"""SELECT o_orderkey, CASE WHEN y = 1998 THEN 0.0 ELSE o_totalprice END AS o_totalprice, y FROM ({YEARLY})""",
)
def overwrite_partition(spark, sf_dir):
    """Rewrite one year twice; the other years stay."""
    path = scratch_path(spark, "rerun")
    rows = _yearly(spark, sf_dir)
    writers.write_partitioned(rows, path, ["y"])
    fixed = rows.filter("y = 1998").withColumn("o_totalprice", F.lit(0.0))
    for _ in range(2):
        writers.overwrite_partitions(fixed, path, ["y"])
    return spark.read.schema("o_orderkey bigint, o_totalprice double, y int").parquet(path)


@query(
    "publish_partition",
    f"""SELECT o_orderkey, CASE WHEN y = 1999 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, y
        FROM ({YEARLY})""",
)
def publish_partition(spark, sf_dir):
    """The new partition is computed from the very table it replaces a part of."""
    path = scratch_path(spark, "published")
    writers.write_partitioned(_yearly(spark, sf_dir), path, ["y"])
    published = spark.read.schema("o_orderkey bigint, o_totalprice double, y int").parquet(path)
    doubled = published.filter("y = 1999").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    writers.publish_partitions(doubled, scratch_path(spark, "staged"), path, ["y"])
    return spark.read.schema(published.schema).parquet(path)


@query("ctas", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def ctas(spark, sf_dir):
    sql = f"SELECT o_custkey, count(*) AS n FROM parquet.`{sf_dir}/orders.parquet` GROUP BY o_custkey"
    return catalog.create_table_as(spark, scratch_name("orders_per_customer"), scratch_path(spark, "ctas"), sql)


@query(
    "insert_into",
    """SELECT c_custkey, c_mktsegment FROM customer UNION ALL SELECT s_suppkey, 'SUPPLIER' FROM supplier""",
)
def insert_into(spark, sf_dir):
    name = scratch_name("parties")
    spark.sql(
        f"CREATE TABLE {name} (c_custkey BIGINT, c_mktsegment STRING) USING parquet LOCATION '{scratch_path(spark, 'ins')}'"
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"), F.lit("SUPPLIER").alias("c_mktsegment")
    )
    catalog.insert_rows(suppliers, name)
    catalog.insert_rows(customers, name, overwrite=True)
    catalog.insert_rows(suppliers, name)
    return spark.table(name)


@query(
    "register_views",
    """SELECT o_orderstatus, count(*) AS n, count(DISTINCT c_nationkey) AS nations
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_orderstatus""",
)
def register_views(spark, sf_dir):
    o, c = scratch_name("v_orders"), scratch_name("v_customers")
    catalog.register_views(table(spark, sf_dir, "orders"), temp=o)
    catalog.register_views(table(spark, sf_dir, "customer"), global_temp=c)
    return spark.sql(
        f"""SELECT o_orderstatus, count(*) AS n, count(DISTINCT c_nationkey) AS nations
            FROM {o} JOIN global_temp.{c} ON o_custkey = c_custkey GROUP BY o_orderstatus"""
    )


@query("partition_register", f"SELECT y, count(*) AS n FROM ({YEARLY}) GROUP BY y")
def partition_register(spark, sf_dir):
    """Date folders written behind the catalog's back become queryable."""
    path, name = scratch_path(spark, "folders"), scratch_name("by_year")
    catalog.partitioned_table(spark, name, path, "o_orderkey BIGINT, o_totalprice DOUBLE, y INT", "y")
    writers.write_partitioned(_yearly(spark, sf_dir), path, ["y"], mode="append")
    catalog.register_partition(spark, name, "y=1995")
    catalog.register_all_partitions(spark, name)
    return spark.table(name).groupBy("y").agg(F.count(F.lit(1)).alias("n"))


def _profile_sql(name: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
            CAST(min({c}) AS VARCHAR) AS lowest, CAST(max({c}) AS VARCHAR) AS highest FROM {name}"""
        for c, t in columns.items()
    )


@query(
    "dataset_profile",
    _profile_sql("customer", {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}),
)
def dataset_profile(spark, sf_dir):
    return readers.dataset_profile(table(spark, sf_dir, "customer"))


SKETCHED = {"l_quantity": "double", "l_discount": "double", "l_tax": "double", "l_linenumber": "int", "l_linestatus": "string"}


def _sketched_sql() -> str:
    lines = """(SELECT l_quantity, l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax, l_linenumber, l_linestatus FROM lineitem)"""
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{kind}' AS data_type, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
            CAST(min({c}) AS VARCHAR) AS lowest, CAST(max({c}) AS VARCHAR) AS highest, count(DISTINCT {c}) AS n_distinct,
            (SELECT max(n) FROM (SELECT count(*) AS n FROM {lines} GROUP BY {c})) AS n_most_frequent FROM {lines}"""
        for c, kind in SKETCHED.items()
    )


@query("dataset_profile_sketched", _sketched_sql())
def dataset_profile_sketched(spark, sf_dir):
    """Folders arrive one after the other; each is sketched once. These columns have few values, for which sketches are exact."""
    store = scratch_path(spark, "profile")
    lines = table(spark, sf_dir, "lineitem").withColumns({c: F.col(c) + 0.0 for c in ("l_discount", "l_tax")})
    for flag in ("A", "N", "R"):
        profile.add_folders(lines.filter(F.col("l_returnflag") == flag).select("l_returnflag", *SKETCHED), store, ["l_returnflag"])
    merged = profile.merged_profile(spark.read.parquet(store), top=1)
    most = F.get("frequent", F.lit(0))["count"].alias("n_most_frequent")
    return merged.select("column_name", "data_type", "n_rows", "n_nulls", "lowest", "highest", "n_distinct", most)


@query("export_query", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def export_query(spark, sf_dir):
    path = scratch_path(spark, "export")
    report = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    writers.export_query(report, path, "csv")
    return readers.read_csv_typed(spark, path, "o_orderpriority string, n bigint")


@query(
    "quarantine_split",
    f"""WITH {roles.RAW_ORDERS}, {roles.CUSTOMERS}, {roles.TYPED},
        tagged AS (SELECT order_id, order_ts, status, concat_ws(',',
            CASE WHEN amount > 0 THEN NULL ELSE 'amount' END,
            CASE WHEN customer_id >= 0 THEN NULL ELSE 'customer' END,
            CASE WHEN order_date IS NOT NULL THEN NULL ELSE 'date' END) AS reason FROM typed)
        SELECT order_id, order_ts, status, reason FROM tagged WHERE reason <> ''""",
)
def quarantine_split(spark, sf_dir):
    """Both outputs are written; the dead-letter table is returned."""
    rules = {
        "amount": F.col("amount") > 0,
        "customer": F.col("customer_id") >= 0,
        "date": F.col("order_date").isNotNull(),
    }
    good, bad = cleansing.quarantine_split(cleansing.type_orders(roles.raw_orders(spark, sf_dir)), rules)
    good_path, bad_path = scratch_path(spark, "good"), scratch_path(spark, "bad")
    writers.quarantine_write(good, bad, good_path, bad_path)
    reason = F.array_join("reason", ",").alias("reason")
    return spark.read.parquet(bad_path).select("order_id", "order_ts", "status", reason)


@query(
    "load_new_files",
    """SELECT event_id, user_id, value FROM events UNION ALL
       SELECT -conv_id - 1, turn, NULL FROM conversations""",
)
def load_new_files(spark, sf_dir):
    """Two deliveries and a rerun in between: each file is loaded once."""
    inbox, root = scratch_path(spark, "inbox"), scratch_path(spark, "feed")
    feed = FileLedger(spark, inbox, root, "event_id bigint, user_id bigint, value double")
    first = table(spark, sf_dir, "events").select(F.col("event_id").alias("EVENT_ID"), "user_id", "value")
    first.write.mode("append").json(inbox)
    feed.load_new_files()
    feed.load_new_files()
    second = table(spark, sf_dir, "conversations").select(
        (-F.col("conv_id") - 1).alias("event_id"), F.col("turn").alias("user_id")
    )
    second.write.mode("append").json(inbox)
    feed.load_new_files()
    return feed.table()


@query("bookmark_reset_backfill", "SELECT event_id, value FROM events")
def bookmark_reset_backfill(spark, sf_dir):
    """Forget the files of some days and load again: nothing is lost or doubled."""
    inbox, root = scratch_path(spark, "inbox"), scratch_path(spark, "feed")
    events = table(spark, sf_dir, "events").withColumn("dt", F.col("ts").cast("date"))
    events.select("event_id", "value", "dt").hint("rebalance", "dt").write.partitionBy("dt").json(inbox)
    feed = FileLedger(spark, inbox, root, "event_id bigint, value double")
    feed.load_new_files()
    feed.forget(text_to_date(F.regexp_extract("path", r"dt=([0-9-]+)", 1)).between("2024-01-10", "2024-01-12"))
    feed.load_new_files()
    return feed.table()


@query("group_small_inputs", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def group_small_inputs(spark, sf_dir):
    """Order files by date and priority, read as few large tasks."""
    small, result = scratch_path(spark, "small"), scratch_path(spark, "counts")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    rows.hint("rebalance", "o_orderpriority").write.partitionBy("o_orderpriority").parquet(small)
    with readers.grouped_inputs(spark, 1 << 30, 1 << 16):
        counts = spark.read.schema("o_orderkey bigint, o_orderpriority string").parquet(small)
        counts.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).write.parquet(result)
    return spark.read.parquet(result)


@query(
    "watermark_increment",
    """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-06-30'""",
)
def watermark_increment(spark, sf_dir):
    from millrace.operators.incremental import watermark_increment as increment

    source = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    loaded = source.filter(F.col("o_orderdate") <= F.lit("1998-06-30").cast("timestamp_ntz"))
    return increment(source, loaded, "o_orderdate")


@query(
    "incremental_model",
    """SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders""",
)
def incremental_model(spark, sf_dir):
    """First run up to a date, second run merges the rest and the ties of that date."""
    from millrace.operators.incremental import incremental_model as model

    source = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    early = source.filter(F.col("o_orderdate") <= F.lit("1998-06-30").cast("timestamp_ntz"))
    latest = [F.desc("o_orderdate"), F.desc("o_orderstatus")]
    path = scratch_path(spark, "model")
    model(None, early, ["o_orderkey"], "o_orderdate", latest).write.parquet(path)
    return model(spark.read.parquet(path), source, ["o_orderkey"], "o_orderdate", latest)


@query(
    "late_partition_reprocess",
    """WITH e AS (SELECT event_id, value, CAST(ts AS DATE) AS event_date FROM events),
       late AS (SELECT DISTINCT event_date FROM e WHERE event_id % 97 = 0)
       SELECT event_date, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM e WHERE event_date IN (SELECT event_date FROM late) GROUP BY event_date""",
)
def late_partition_reprocess(spark, sf_dir):
    from millrace.functions.columns import money_total
    from millrace.operators.incremental import late_partition_reprocess as reprocess

    events = table(spark, sf_dir, "events").select("event_id", "value", F.col("ts").cast("date").alias("event_date"))
    late = events.filter("event_id % 97 = 0")
    on_time = events.filter("event_id % 97 <> 0")
    redo = reprocess(on_time, late, "event_date")
    return redo.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"), money_total("value").alias("total"))
